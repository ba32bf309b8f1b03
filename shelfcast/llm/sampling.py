"""Bounded samples of labelled rows, for fitting only."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, giving_back, spark_schema


#: Labels that a sample takes; more raise an error.
MOST_LABELS = 500


def crc_of(column):
    """crc32 of a value written as text."""
    return F.crc32(column.cast("string").cast("binary"))


def sampled_ids(labels: DataFrame, rows: int, most_labels: int = MOST_LABELS) -> DataFrame:
    """(sample_id, label) for up to ``rows`` ids of each label (columns id, label), those with the smallest hashes.

    Null ids and labels are left out. The labels are counted first; a share of the hashes that holds about four times
    the rows wanted is cut out where the rows are read, so what is ranked does not grow with the input.
    """
    known = labels.where("id is not null and label is not null").select("id", "label")
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(most_labels + 1).collect()
    if len(counts) > most_labels:
        raise ValueError(f"more than {most_labels} labels")
    shares = known.sparkSession.createDataFrame([(r["label"], min(1.0, 4 * rows / r["n"])) for r in counts], T.StructType([known.schema["label"], T.StructField("share", T.DoubleType())]))
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))
    few = known.join(F.broadcast(shares), "label").where(place <= F.col("share"))  # ``most_labels`` rows at most
    order = Window.partitionBy("label").orderBy(place, "id")
    return few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows).select(F.col("id").alias("sample_id"), "label")


def sample_features(docs: DataFrame, ids: DataFrame, features: Callable[[bytes], np.ndarray]) -> DataFrame:
    """(sample_id, label, places, values): the non-zero features of the sampled documents (doc_id, text)."""
    picked = docs.join(F.broadcast(ids), docs["doc_id"] == ids["sample_id"]).select("sample_id", "text", "label")  # bounded by the sample
    label = picked.schema["label"].dataType
    fields = [("sample_id", picked.schema["sample_id"].dataType), ("label", label), ("places", T.ArrayType(T.IntegerType())), ("values", T.ArrayType(T.FloatType()))]

    def run(batches):
        schema = arrow_schema(fields)
        for batch in batches:
            at = 0
            for part, texts in byte_chunks(batch):
                rows = [features(t or b"") for t in texts]
                places = [np.flatnonzero(r).astype(np.int32) for r in rows]
                yield batch_of(schema, part, batch.column(2).slice(at, len(part)), places, [r[p].astype(np.float32) for r, p in zip(rows, places, strict=True)])
                at += len(part)

    return picked.mapInArrow(giving_back(run), spark_schema(fields))


def dense(places: pa.Array, values: pa.Array, width: int) -> np.ndarray:
    """Sparse rows as a matrix."""
    out = np.zeros((len(places), width), dtype=np.float32)
    counts = np.array([len(p) for p in places])
    row = np.repeat(np.arange(len(places)), counts)
    out[row, places.flatten().to_numpy(zero_copy_only=False)] = values.flatten().to_numpy(zero_copy_only=False)
    return out


def in_one_task(sample: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes:
    """The model that ``fit`` makes of a bounded sample, in one task on an executor."""
    schema = pa.schema([pa.field("model", pa.binary())])

    def run(batches):
        read = list(batches)
        if read:
            yield batch_of(schema, [fit(pa.Table.from_batches(read))])

    found = sample.repartition(1).sortWithinPartitions("sample_id").mapInArrow(giving_back(run), "model binary").collect()
    return found[0]["model"] if found else b""
