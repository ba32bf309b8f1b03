"""Quality rules: a hashed n-gram logistic regression, calibrated, with a fixed threshold, behind two base rules."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, document_rows, giving_back, spark_schema
from shelfcast.llm.sampling import dense, in_one_task, sample_features, sampled_ids

#: Buckets of word n-grams (one and two words, half each) and of 3-byte character n-grams.
WORD_BUCKETS, CHAR_BUCKETS = 2048, 2048
#: Labelled rows of each label that the fit reads at most.
SAMPLE_ROWS = 1000


def word_numbers(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Each word as its number among the distinct words, and those."""
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    return numbers, list(known)


def repeated_words(numbers: np.ndarray, distinct: int) -> int:
    """Words that lie in a 3-word window found twice or more, the first time included."""
    if len(numbers) < 4:
        return 0
    if distinct < 1 << 20:
        windows = (numbers[:-2] * distinct + numbers[1:-1]) * distinct + numbers[2:]
    else:
        pairs = np.unique(numbers[:-2] * distinct + numbers[1:-1], return_inverse=True)[1].reshape(-1)
        windows = pairs * distinct + numbers[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    often = np.zeros(len(windows), dtype=bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    inside = np.zeros(len(numbers), dtype=bool)
    for k in range(3):
        inside[k : k + len(often)] |= often
    return int(inside.sum())


def _share(buckets: np.ndarray, size: int) -> np.ndarray:
    """Square roots of the shares of the buckets: a vector of length one."""
    counts = np.bincount(buckets, minlength=size)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def features(text: bytes, numbers: np.ndarray | None = None, distinct: list[bytes] | None = None) -> np.ndarray:
    if numbers is None:
        numbers, distinct = word_numbers(text.split())
    half = WORD_BUCKETS // 2
    hashed = np.array([zlib.crc32(w) for w in distinct], dtype=np.uint32)[numbers]
    pairs = (hashed[:-1] * np.uint32(2654435761) ^ hashed[1:]) * np.uint32(2246822519) >> np.uint32(16)
    raw = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    chars = (raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]) * np.uint32(2654435761) >> np.uint32(12)
    return np.concatenate([_share(hashed % half, half), _share(pairs % half, half), _share(chars % CHAR_BUCKETS, CHAR_BUCKETS)])


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and constant of a logistic regression, by accelerated gradient steps on centred features."""
    mean = x.mean(axis=0)
    rows = x - mean
    rate = 1 / (0.25 * float((rows * rows).sum(axis=1).max(initial=0)) + 0.25 + penalty)
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    wv, bv = w, b
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ wv + bv, -30, 30)))
        gap = (p - y).astype(np.float32) / max(1, len(y))
        new_w, new_b = wv - rate * len(y) / max(1, len(y)) * (rows.T @ gap + penalty * wv), bv - rate * float(gap.sum())
        pull = t / (t + 3)
        wv, bv = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return w, b - float(mean @ w)


def fit_platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and constant that turn margins into probabilities (Platt's targets, Newton steps)."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margin * margin).sum() + 1e-6, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a, b


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> bytes:
    """The model as bytes, learnt from up to ``sample_rows`` rows of each label of ``labels`` (id, label: 1 good, 0 bad).

    Margins of two folds, each scored by the other's fit, give the calibration; the share of good rows among all
    labelled ones corrects for the balanced sample. Without both labels the model is empty and keeps everything.
    """
    labels = labels.select("id", F.col("label").cast("int").alias("label")).where("label in (0, 1)")
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    width = WORD_BUCKETS + CHAR_BUCKETS

    def fit(table: pa.Table) -> bytes:
        y = table["label"].to_numpy().astype(np.float32)
        if len(set(y.tolist())) < 2:
            return b""
        x = dense(table["places"].combine_chunks(), table["values"].combine_chunks(), width)
        fold = np.arange(len(y)) % 2
        margin = np.zeros(len(y))
        for k in (0, 1):
            w, b = fit_logistic(x[fold != k], y[fold != k])
            margin[fold == k] = x[fold == k] @ w + b
        slope, level = fit_platt(margin, y)
        w, b = fit_logistic(x, y)
        prior = np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
        out = io.BytesIO()
        np.savez(out, w=w, b=np.array([b, slope, level + prior]))
        return out.getvalue()

    if counts.keys() != {0, 1}:
        return b""
    return in_one_task(sample_features(docs, sampled_ids(labels, sample_rows), features), fit)


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: counts of the base rules, base_failed, good (probability of label 1) and kept.

    Base rules: fewer than 50 words, or over half of the words in repeated 3-word windows. ``kept``: no base rule
    failed and ``good`` is at least ``least``. Null texts have no words and fail. Repeated rows are scored alike.
    """
    docs = document_rows(df, id_col, text_col)
    model = fit_quality(docs, labels, sample_rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [("doc_id", docs.schema["doc_id"].dataType)] + [(n, T.LongType()) for n in names]
    fields += [("base_failed", T.BooleanType()), ("good", T.DoubleType()), ("kept", T.BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        known = np.load(io.BytesIO(model)) if model else None
        w, (b, slope, level) = (known["w"], known["b"]) if model else (None, (0, 0, 0))
        for batch in batches:
            for ids, texts in byte_chunks(batch):
                counts, goods = [], []
                for t in texts:
                    t = t or b""
                    numbers, distinct = word_numbers(t.split())
                    lines = [line for line in t.split(b"\n") if line.strip()]
                    plain = len(t) - int(np.count_nonzero((np.frombuffer(t, dtype=np.uint8) & 0xC0) == 0x80)) - sum(t.count(c) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
                    counts.append((len(numbers), plain, len(t) - len(t.translate(None, b"#*$%&|<>")), len(lines) - len(set(lines)), repeated_words(numbers, len(distinct))))
                    margin = slope * (float(features(t, numbers, distinct) @ w) + b) + level if model else 0.0
                    goods.append(float(1 / (1 + np.exp(-np.clip(margin, -500, 500)))))
                failed = [c[0] < 50 or 100 * c[4] > 50 * c[0] for c in counts]
                yield batch_of(schema, ids, *zip(*counts, strict=True), failed, goods, [not f and g >= least for f, g in zip(failed, goods, strict=True)])

    return docs.mapInArrow(giving_back(run), spark_schema(fields))
