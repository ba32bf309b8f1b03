"""Readers for raw feeds and marts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POS_SCHEMA = T.StructType(
    [
        T.StructField("tx_id", T.StringType()),
        T.StructField("isbn13", T.StringType()),
        T.StructField("qty", T.IntegerType()),
        T.StructField("unit_price", T.LongType()),
        T.StructField("total_price", T.LongType()),
        T.StructField("channel", T.StringType()),
        T.StructField("location_id", T.IntegerType()),
        T.StructField("ts", T.StringType()),
    ]
)


def read_pos(spark: SparkSession, path: str) -> DataFrame:
    """Gzip NDJSON below ``path`` at any depth, with the fixed schema (no inference pass)."""
    return spark.read.schema(POS_SCHEMA).option("recursiveFileLookup", "true").json(path)


def read_ndjson(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """NDJSON below ``path``, projected to ``columns`` (name to type); bad values become NULL.

    Everything is read as text, so one odd file cannot change the types.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    return raw.select(*[F.col(c).try_cast(t).alias(c) if t != "string" else F.col(c) for c, t in columns.items()])


def read_typed_folders(spark: SparkSession, base: str, kinds: list[str], schema: str, kind_column: str = "event_type") -> DataFrame | None:
    """One folder per type, read with the given schema and tagged with its type; missing folders are left out."""
    found = None
    for kind in kinds:
        try:
            part = spark.read.schema(schema).option("recursiveFileLookup", "true").json(f"{base}/{kind}").withColumn(kind_column, F.lit(kind))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = part if found is None else found.unionByName(part)
    return found


def hour_filter(now: datetime, hours: int = 2):
    """Partition predicate for the current hour and the ones before it."""
    wanted = None
    for back in range(hours):
        h = now - timedelta(hours=back)
        one = (F.col("year") == h.year) & (F.col("month") == h.month) & (F.col("day") == h.day) & (F.col("hour") == h.hour)
        wanted = one if wanted is None else wanted | one
    return wanted


def read_recent_hours(spark: SparkSession, path: str, now: datetime, schema: str, hours: int = 2, fmt: str = "json") -> DataFrame:
    """Only the hour folders that are needed; the predicate is on partition columns, and nothing is inferred."""
    return spark.read.format(fmt).schema(schema).load(path).filter(hour_filter(now, hours))


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Header CSV as text columns; types are set by schema alignment afterwards."""
    df = spark.read.option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple | None = None, parts: int = 8,
    properties: dict | None = None,
) -> DataFrame:
    """A database table, read in parallel slices of a numeric key when one is given."""
    if key is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    return spark.read.jdbc(
        url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts, properties=properties or {}
    )


def export_tables(tables: dict[str, DataFrame], base: str, partition: dict[str, str] | None = None) -> dict[str, str]:
    """Write each table as a mart folder and return the folders."""
    out = {}
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        column = (partition or {}).get(name)
        if column:
            writer = writer.partitionBy(column)
        out[name] = f"{base}/{name}"
        writer.parquet(out[name])
    return out
