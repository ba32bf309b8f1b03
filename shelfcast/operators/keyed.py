"""Per-key choices: survivors, latest rows, global ranks.

All of them aggregate instead of ranking inside a window, so that a key which
holds a large part of the rows is reduced on the map side first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import through_disk


def _pick(df: DataFrame, keys: list[str], order: list[str], latest: bool) -> DataFrame:
    """The smallest or largest row per key, compared by ``order`` and then by the other columns."""
    rest = [c for c in order if c not in keys] + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.distinct()
    best = F.max if latest else F.min
    picked = df.groupBy(*keys).agg(best(F.struct(*rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedupe_first(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by all other columns."""
    return _pick(df, keys, list(order), latest=False)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order``, ties broken by all other columns."""
    return _pick(df, keys, list(order), latest=True)


def global_rank(df: DataFrame, key: str, rank: str = "rank_no", splits: int | None = None) -> DataFrame:
    """1-based position of every row by ``key``, in the key's own order, NULL first, over the whole table.

    A window without partitions would bring all rows into one task. Here the rows are range-partitioned by the key,
    ranked inside each range and shifted by the sizes of the ranges before it. How the ranges are cut only balances
    the work. The ranged rows are written once, so that sizes and ranks see the same ranges. Equal keys are ranked
    in no particular order.
    """
    by = F.col(key).asc_nulls_first()
    ranged = df.repartitionByRange(splits, by) if splits else df.repartitionByRange(by)
    placed = through_disk(df.sparkSession, ranged.withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    ranked = placed.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(by)))
    # One offset row for each range, so this broadcast is bounded by the number of partitions.
    return (
        ranked.join(F.broadcast(offsets), "_part")
        .withColumn(rank, (F.col("_row") + F.col("_offset")).cast("bigint"))
        .drop("_part", "_row", "_offset")
    )


def sorted_bijection(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Pair the n-th smallest key of one side with the n-th smallest of the other."""
    a = global_rank(left.select(left_key).distinct(), left_key)
    b = global_rank(right.select(right_key).distinct(), right_key)
    return a.join(b, "rank_no")
