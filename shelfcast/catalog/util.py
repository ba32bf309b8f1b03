"""Small helpers of the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 4, only: list[str] | None = None) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    names = [n for n, t in df.dtypes if t == "double" and (only is None or n in only)]
    return df.withColumns({n: F.round(n, digits) for n in names}) if names else df


def digest(df: DataFrame, keys: list[str], day: str, ints=(), floats=(), texts=(), daily=None) -> DataFrame:
    """One row per series of a dense table: its rows, and of every column the sum, the ends, and the sum by day number.

    Dense tables have a row for every book, place and day; they are compared by series instead of row by row.
    Texts are grouped by first: their ends need a sorted aggregation, which then sees few rows.
    ``daily`` names the numbers that change from day to day. The others keep their values for many days, so rows that
    are equal in them are counted first, and their figures are taken from the counts.
    """
    at = F.datediff(day, F.lit("1990-01-01").cast("date"))
    held = [] if daily is None else [c for c in (*ints, *floats) if c not in daily]
    moving = [c for c in (*ints, *floats) if c not in held]
    merge = {"sum": F.sum, "min": F.min, "max": F.max, "by_day": F.sum}
    parts = [F.count("*").alias("row_count"), F.min(day).alias(f"{day}_min"), F.max(day).alias(f"{day}_max")]
    parts += [merge[n](c).alias(f"{c}_{n}") for c in moving for n in ("sum", "min", "max")]
    parts += [F.sum(F.col(c) * at).alias(f"{c}_by_day") for c in ints if c in moving]
    if held:
        parts.append(F.sum(at).alias("_days"))
    if not held:
        first = df.groupBy(*keys, *texts).agg(*parts)
    else:
        # With the texts in one struct, Spark leaves out a first small hash map that so many groups would only overflow.
        named = F.struct(*texts).alias("_texts")
        first = df.groupBy(*keys, named, *held).agg(*parts).select("*", *[F.col(f"_texts.{c}").alias(c) for c in texts])
        parts = [merge[n](c).alias(c) for c, n in (("row_count", "sum"), (f"{day}_min", "min"), (f"{day}_max", "max"))]
        parts += [merge[n](f"{c}_{n}").alias(f"{c}_{n}") for c in moving for n in (("sum", "min", "max", "by_day") if c in ints else ("sum", "min", "max"))]
        parts += [f.alias(f"{c}_{n}") for c in held for n, f in (("sum", F.sum(F.col(c) * F.col("row_count"))), ("min", F.min(c)), ("max", F.max(c)))]
        parts += [F.sum(F.col(c) * F.col("_days")).alias(f"{c}_by_day") for c in held if c in ints]
        first = first.groupBy(*keys, *texts).agg(*parts)
    whole = [F.sum("row_count").alias("row_count")]
    for c in ints:
        whole += [merge[n](f"{c}_{n}").cast("bigint" if n in ("sum", "by_day") else df.schema[c].dataType).alias(f"{c}_{n}") for n in merge]
    for c in floats:
        whole += [F.round(merge[n](f"{c}_{n}"), 3).alias(f"{c}_{n}") for n in ("sum", "min", "max")]
    for c in texts:
        whole += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    whole += [F.min(f"{day}_min").alias(f"{day}_min"), F.max(f"{day}_max").alias(f"{day}_max")]
    return first.groupBy(*keys).agg(*whole)


def digest_sql(sql: str, keys: list[str], day: str, ints=(), floats=(), texts=()) -> str:
    """The same in SQL over a statement or a table."""
    out = ["count(*) AS row_count"]
    for c in ints:
        out += [f"CAST(sum({c}) AS BIGINT) AS {c}_sum", f"min({c}) AS {c}_min", f"max({c}) AS {c}_max", f"CAST(sum({c} * ({day} - DATE '1990-01-01')) AS BIGINT) AS {c}_by_day"]
    for c in floats:
        out += [f"round(sum({c}), 3) AS {c}_sum", f"round(min({c}), 3) AS {c}_min", f"round(max({c}), 3) AS {c}_max"]
    for c in [*texts, day]:
        out += [f"min({c}) AS {c}_min", f"max({c}) AS {c}_max"]
    return f"SELECT {', '.join(keys)}, {', '.join(out)} FROM ({sql}) GROUP BY {', '.join(keys)}"
