"""Language ID: the nearest of several clustered centroids per language, by cosine of TF-IDF n-gram vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, document_rows, giving_back, spark_schema
from shelfcast.llm.sampling import dense, sample_features, sampled_ids

#: Buckets of n-grams of one, two and three bytes of lower-cased text.
BUCKETS = (256, 2048, 4096)
WIDTH = sum(BUCKETS)
#: Documents of each language that the fit reads at most, centroids per language, rounds of clustering.
SAMPLE_ROWS, CENTROIDS, ROUNDS = 500, 4, 12
NOT_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def features(text: bytes) -> np.ndarray:
    """Damped counts of the n-grams; signs, digits and blanks all read as a blank."""
    low = text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()
    raw = np.frombuffer(low.translate(NOT_LETTERS), dtype=np.uint8).astype(np.uint32)
    two = raw[:-1] << np.uint32(8) | raw[1:]
    three = two[:-1] << np.uint32(8) | raw[2:]
    counts = [np.bincount(raw, minlength=BUCKETS[0])]
    counts += [np.bincount(x * np.uint32(2654435761) >> np.uint32(32 - b.bit_length() + 1), minlength=b) for x, b in zip((two, three), BUCKETS[1:])]
    counts[0][32] = 0  # a blank alone tells nothing
    return np.log1p(np.concatenate(counts)).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=-1, keepdims=True)), 1e-12)


def cluster(x: np.ndarray, centroids: int, rounds: int) -> np.ndarray:
    """Spherical k-means of unit rows, started from rows spread evenly by their cosine with the mean.

    Clusters of less than a quarter of an even share go: they hold wrongly labelled documents.
    """
    k = min(centroids, len(x))
    spread = np.argsort(x @ _unit(x.sum(axis=0)), kind="stable")
    c = x[spread[((np.arange(k) + 0.5) * len(x) / k).astype(int)]]
    for _ in range(rounds):
        at = np.argmax(x @ c.T, axis=1)
        size = np.bincount(at, minlength=len(c))
        c = _unit(np.stack([x[at == j].sum(axis=0) for j in np.flatnonzero(4 * k * size >= len(x))]))
    return c


def fit_languages(docs: DataFrame, known: DataFrame, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """(language, centroid, least cosine) rows and the idf weights, from up to ``sample_rows`` rows of each language.

    ``known`` has columns id and label (the language). The least cosine of a centroid is that of its farthest
    one in a hundred sampled documents, less a tenth.
    """
    sample = sample_features(docs, sampled_ids(known, sample_rows), features).persist()
    try:
        n = sample.count()
        df = np.zeros(WIDTH)
        for r in sample.select(F.explode("places").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect():  # WIDTH rows at most
            df[r["p"]] = r["n"]
        idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
        out = T.StructType([T.StructField("label", T.StringType()), T.StructField("centroid", T.ArrayType(T.FloatType())), T.StructField("least", T.DoubleType())])
        schema = arrow_schema([(f.name, f.dataType) for f in out])

        def learn(group: pa.Table) -> pa.Table:
            group = group.sort_by("sample_id")
            x = _unit(dense(group["places"].combine_chunks(), group["values"].combine_chunks(), WIDTH) * idf)
            c = cluster(x, centroids, ROUNDS)
            cos = x @ c.T
            at = cos.argmax(axis=1)
            least = [0.9 * float(np.quantile(cos[at == k, k], 0.01)) if (at == k).any() else 0.0 for k in range(len(c))]
            return pa.Table.from_batches([batch_of(schema, [group["label"][0].as_py()] * len(c), list(c.astype(np.float32)), least)])

        rows = sample.groupBy("label").applyInArrow(learn, out).collect()  # bounded: CENTROIDS rows a language
    finally:
        sample.unpersist()
    rows = sorted(rows, key=lambda r: (r["label"], r["centroid"]))
    matrix = np.array([r["centroid"] for r in rows], dtype=np.float32).reshape(len(rows), WIDTH)
    return [r["label"] for r in rows], matrix, np.array([r["least"] for r in rows]), idf


def identify_language(df: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS) -> DataFrame:
    """One row per input row: doc_id, nearest (language of the nearest centroid), score (its cosine) and rejected.

    ``nearest`` is null for null texts, texts without a letter, and where nothing was learnt; such rows and those
    farther from their centroid than its documents were are ``rejected``. Ties go to the first language by name.
    """
    docs = document_rows(df, id_col, text_col)
    names, matrix, least, idf = fit_languages(docs, known.select("id", F.col("label").cast("string").alias("label")), sample_rows, centroids)
    fields = [("doc_id", docs.schema["doc_id"].dataType), ("nearest", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in batches:
            for ids, texts in byte_chunks(batch):
                nearest, score, rejected = [], [], []
                for at in range(0, len(texts), 256):
                    part = texts[at : at + 256]
                    if not names:
                        cos = np.zeros((len(part), 1))
                    else:
                        cos = _unit(np.stack([features(t or b"") for t in part]) * idf) @ matrix.T
                    best = cos.argmax(axis=1)
                    for t, k, c in zip(part, best.tolist(), cos.max(axis=1).tolist(), strict=True):
                        read = bool(names) and t is not None and has_letter(t)
                        nearest.append(names[k] if read else None)
                        score.append(min(1.0, max(0.0, c)) if read else 0.0)
                        rejected.append(not read or c < least[k])
                yield batch_of(schema, ids, nearest, score, rejected)

    return docs.mapInArrow(giving_back(run), spark_schema(fields))
