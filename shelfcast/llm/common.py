"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfcast.session import fresh_dir

#: White space of the contracts: space and 0x09 to 0x0D. ``bytes.split`` and ``bytes.strip`` use the same set.
BLANKS = " \t\n\r\x0b\x0c"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Inside, a finished write gives its shuffle files back at once instead of when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def giving_back(run: Callable) -> Callable:
    """``run`` over Arrow batches; at its end the worker, which serves further tasks, gives its free memory back."""

    def whole(batches):
        import ctypes
        import gc

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # other C libraries do without
                ctypes.CDLL(None).malloc_trim(0)

    return whole


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage, so a lost executor costs one stage and not the chain. The folder goes when the session ends.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, f"{label}-{uuid.uuid4().hex[:6]}")
    with shuffle_files_removed(spark):
        df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def document_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under the names ``doc_id`` and ``text``; other columns cannot clash with results."""
    return df.select(df[id_col].alias("doc_id"), df[text_col].cast("string").alias("text"))


def whole_rows(df: DataFrame, id_col: str) -> DataFrame:
    """The id as ``doc_id`` and the whole row as the struct ``row``: what passes through Python comes out unchanged."""
    return df.select(df[id_col].alias("doc_id"), F.struct("*").alias("row"))


def ids_and_texts(batch: pa.RecordBatch, text_col: str) -> pa.RecordBatch:
    """A batch of ``whole_rows`` as (doc_id, text), without a copy of the texts."""
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).field(text_col).cast(pa.string())], names=["doc_id", "text"])


def arrow_schema(fields: list[tuple[str, T.DataType]]) -> pa.Schema:
    return pa.schema([pa.field(name, to_arrow_type(kind)) for name, kind in fields])


def spark_schema(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def byte_chunks(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[tuple[pa.Array, list[bytes | None]]]:
    """The ids and UTF-8 texts of a batch in pieces of about ``limit`` bytes, a document never cut.

    Only the texts of one piece are Python objects at a time.
    """
    ids, texts = batch.column(0), batch.column(1)
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= limit or i + 1 == len(texts):
            yield ids.slice(start, i + 1 - start), texts.slice(start, i + 1 - start).cast(pa.large_binary()).to_pylist()
            start, size = i + 1, 0


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
