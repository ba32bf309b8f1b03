"""Routing of mart files and alignment of loaded columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.domain import MART_TABLES
from shelfcast.functions.columns import case_map

# Paths that are never data.
INTERNAL = r"^functions/|^pipelines/|\.zip$|\.json$|\.spark-staging-|/_temporary/"


def is_internal(path) -> Column:
    return F.col(path).rlike(INTERNAL)


def is_mart_parquet(path) -> Column:
    p = F.col(path)
    return p.startswith("mart/") & p.endswith(".parquet") & ~is_internal(path)


def route_paths(paths: DataFrame, path: str = "path", table_map: dict | None = None, allowed: list[str] | None = None) -> DataFrame:
    """Adds folder, base prefix, target table and partition flag of every object path.

    The folder is the part after ``mart/``; without such a part it is the first
    one, and the base ends before the first ``key=value`` part.
    """
    mapping = table_map or MART_TABLES
    if allowed is not None:
        mapping = {k: v for k, v in mapping.items() if v in allowed}
    clean = F.regexp_replace(F.col(path), "^/+|/+$", "")
    parts = F.split(clean, "/")
    at = F.array_position(parts, "mart")
    in_mart = (at > 0) & (F.size(parts) > at)
    folder = F.when(in_mart, F.try_element_at(parts, (at + 1).cast("int"))).otherwise(parts.getItem(0))
    hive_base = F.regexp_extract(F.col(path), "^(.*?)/[^/]+=", 1)
    base = F.when(in_mart, F.array_join(F.slice(parts, F.lit(1), (at + 1).cast("int")), "/")).when(hive_base != "", hive_base).otherwise(folder)
    return paths.select(
        "*",
        folder.alias("folder"),
        base.alias("base_prefix"),
        case_map(folder, mapping, None).alias("target_table"),
        F.col(path).rlike("/[^/]+=").alias("is_partitioned"),
        is_internal(path).alias("is_internal"),
        is_mart_parquet(path).alias("is_loadable"),
    )


def files_of(df: DataFrame) -> DataFrame:
    """Distinct files behind a file-based frame with their row counts."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("row_count"))


def align(df: DataFrame, target: T.StructType, aliases: dict[str, str] | None = None) -> DataFrame:
    """Project onto ``target``: own column, else alias column, else numeric literal, else NULL.

    Casts never raise; a value that does not fit becomes NULL.
    """
    aliases = aliases or {}
    have = set(df.columns)
    out = []
    for field in target.fields:
        source = aliases.get(field.name)
        if field.name in have:
            value = F.col(f"`{field.name}`")
        elif source in have:
            value = F.col(f"`{source}`")
        elif source is not None and re.fullmatch(r"-?\d+(\.\d+)?", source):
            value = F.lit(source)
        else:
            value = F.lit(None).cast("string")
        out.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*out)


def load_partitioned(spark: SparkSession, path: str, target: T.StructType, aliases: dict | None = None) -> DataFrame:
    """Read a mart folder, partition columns included, and align it."""
    return align(spark.read.parquet(path), target, aliases)
