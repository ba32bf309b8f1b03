"""Mergeable quantile sketches: errors of a day are sketched once, any period is a merge of its days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items a KLL sketch keeps per level. Its rank error falls with them.
K = 800


def rank_error(k: int = K) -> float:
    """By how much a rank may be off, as a share of the values, at 99 % confidence: published figure of KLL for one quantile."""
    return 2.296 / k**0.9723  # fixed values of the published bound


def sketch_by(df: DataFrame, group: list[str], value: str, k: int = K) -> DataFrame:
    """One sketch of the values per group, built on the map side: a few KB however many rows. NULL values do not count.

    A group without a value has no row.
    """
    return df.filter(F.col(value).isNotNull()).groupBy(*group).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def rank_shares(value: str, quantile: str) -> dict[str, Column]:
    """Aggregates: the share of values below a quantile and the share up to it. A right rank lies between the two."""
    v, q = F.col(value), F.col(quantile)
    return {"below": F.avg((v < q).cast("double")), "upto": F.avg((v <= q).cast("double"))}


def merged_quantiles(sketches: DataFrame, group: list[str], names: dict[str, float], among: Column | None = None) -> DataFrame:
    """Approximate quantiles per group of all stored sketches, or of those ``among`` which is true, and how many values they hold.

    A quantile is one of the values, the one whose rank is within ``rank_error`` of the wanted one. Only sketches are read.
    """
    rows = sketches if among is None else sketches.filter(among)
    merged = rows.groupBy(*group).agg(F.kll_merge_agg_double("sketch").alias("_s"))
    quantiles = [F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(n) for n, q in names.items()]
    return merged.select(*group, F.kll_sketch_get_n_double("_s").alias("n"), *quantiles)
