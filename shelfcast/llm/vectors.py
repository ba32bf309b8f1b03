"""Vectors as whole numbers, for the operators that must be exact.

Entries become ``floor(scale * c)`` and travel as little-endian integers of the smallest width that holds the row, so
equal vectors have equal bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, giving_back, spark_schema

WIDTHS = (1, 2, 4, 8)
TOP = float(1 << 63)


def dimension(df: DataFrame, vec_col: str) -> int:
    """The length that most vectors have (the greater one of a tie); 0 if there is none. One row comes to the driver."""
    sizes = df.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return most[0]["d"] if most else 0


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * c)`` as 64-bit integers; what is beyond them takes the nearest one."""
    low = np.floor(scale * values)
    out = np.where(np.abs(low) < TOP, low, 0).astype(np.int64)
    out[low >= TOP] = np.iinfo(np.int64).max
    out[low <= -TOP] = np.iinfo(np.int64).min
    return out


def packed(rows: np.ndarray) -> list[bytes]:
    """Each row as bytes of its smallest width."""
    top = np.maximum(rows.max(axis=1), -1 - rows.min(axis=1))
    width = np.select([top < 1 << (8 * w - 1) for w in WIDTHS[:-1]], WIDTHS[:-1], WIDTHS[-1])
    out: list[bytes] = [b""] * len(rows)
    for w in WIDTHS:
        at = np.flatnonzero(width == w)
        for i, row in zip(at.tolist(), rows[at].astype(f"<i{w}"), strict=True):
            out[i] = row.tobytes()
    return out


def unpacked(column: pa.Array, d: int) -> np.ndarray:
    """The 64-bit integers of ``packed`` rows."""
    out = np.zeros((len(column), d), dtype=np.int64)
    size = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for w in WIDTHS:
        at = np.flatnonzero(size == w * d)
        if len(at):
            out[at] = np.frombuffer(b"".join(column.take(pa.array(at)).to_pylist()), dtype=f"<i{w}").reshape(-1, d)
    return out


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, d: int, scale: int) -> DataFrame:
    """(vec_id, x, length2): the packed whole numbers of every vector of ``d`` finite entries and their sum of squares.

    Rows with a null vector, a null or non-finite entry or another number of entries are left out. ``length2`` is null
    where it does not fit in 64 bits. Other columns are not read.
    """
    rows = df.select(df[id_col].alias("vec_id"), df[vec_col].cast("array<double>").alias("v")).where(F.size("v") == d)
    fields = [("vec_id", rows.schema["vec_id"].dataType), ("x", T.BinaryType()), ("length2", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in batches:
            flat = batch.column(1).flatten()
            values = flat.to_numpy(zero_copy_only=False).reshape(-1, d)  # null entries are NaN
            good = np.flatnonzero(np.isfinite(values).all(axis=1))
            x = whole_numbers(values[good], scale)
            rough = (x.astype(np.float64) ** 2).sum(axis=1)
            exact = [int(s) if r < 2.0**62 else sum(int(v) ** 2 for v in row) for s, r, row in zip((x * x).sum(axis=1), rough, x, strict=True)]
            yield batch_of(schema, batch.column(0).take(pa.array(good)), packed(x), [s if s < 1 << 63 else None for s in exact])

    return rows.mapInArrow(giving_back(run), spark_schema(fields))


def in_one_place(sums: DataFrame, fit) -> bytes:
    """What ``fit`` makes of a table whose size depends on the dimension alone, in one task on an executor; b"" of none."""
    schema = pa.schema([pa.field("model", pa.binary())])

    def run(batches):
        read = list(batches)
        if read:
            yield batch_of(schema, [fit(pa.Table.from_batches(read))])

    found = sums.repartition(1).mapInArrow(giving_back(run), "model binary").collect()
    return found[0]["model"] if found else b""
