"""Forecast error metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import safe_ratio
from shelfcast.operators.quantiles import exact_quantiles

def stack_models(df: DataFrame, models: dict[str, Column], keep: list[str], actual: str) -> DataFrame:
    """One scored row per model, out of a single pass over the input."""
    entries = [F.struct(F.lit(name).alias("name"), c.cast("double").alias("p")) for name, c in models.items()]
    return df.select(*keep, F.col(actual).cast("double").alias("actual"), F.explode(F.array(*entries)).alias("m")).select(
        F.col("m.name").alias("model"), *keep, "actual", F.col("m.p").alias("predicted")
    )


def with_total_segment(df: DataFrame, segment: str = "demand_segment") -> DataFrame:
    """Each row once under its own segment and once under ``all``."""
    own = F.col(segment)
    both = F.when(own.isNull(), F.array(F.lit("all"))).otherwise(F.array(F.lit("all"), own))
    return df.withColumn(segment, F.explode(both))


def _sums() -> list[Column]:
    n = F.col("_n")
    total = F.sum(n)
    diff = F.col("actual") - F.col("predicted")
    size = (F.abs("actual") + F.abs("predicted")) / 2
    under, over = F.greatest(diff, F.lit(0.0)), F.greatest(-diff, F.lit(0.0))
    relative = safe_ratio(F.abs(diff), size)
    return [
        total.alias("row_count"),
        F.sum(F.col("actual") * n).alias("actual_sum"),
        F.sum(F.col("predicted") * n).alias("predicted_sum"),
        (F.sum(F.abs(diff) * n) / total).alias("mae"),
        F.sqrt(F.sum(diff * diff * n) / total).alias("rmse"),
        safe_ratio(F.sum(F.abs(diff) * n), F.sum(F.abs("actual") * n)).alias("wape"),
        safe_ratio(F.sum(relative * n), F.sum(F.when(relative.isNotNull(), n))).alias("smape"),
        (F.sum(-diff * n) / total).alias("bias"),
        (F.sum(F.when(diff > 0, n).otherwise(0)) / total).alias("underforecast_rate"),
        F.sum(under * n).alias("underforecast_units"),
        F.sum(over * n).alias("overforecast_units"),
        (1 - safe_ratio(F.sum(under * n), F.sum(F.abs("actual") * n))).alias("fill_rate_proxy"),
    ]


def error_metrics(
    scored: DataFrame, group: list[str], quantiles: dict[str, float] | None = None, few_groups: bool = False, weight: str | None = None
) -> DataFrame:
    """MAE, RMSE, WAPE, sMAPE, bias, order quantities and error quantiles per group.

    Equal (actual, predicted) pairs are counted first. Sums and quantiles both
    start from that one shuffle, so the forecasts are computed only once.
    ``few_groups`` is for groups whose number the code fixes, such as model names
    and demand classes; their cut points may then be broadcast. ``weight`` names a
    column that says how many times a row counts.
    """
    quantiles = quantiles or {"p50_abs_error": 0.5, "p90_abs_error": 0.9, "p95_abs_error": 0.95}
    pairs = scored.groupBy(*group, "actual", "predicted").agg((F.sum(weight) if weight else F.count("*")).alias("_n"))
    sums = pairs.groupBy(*group).agg(*_sums())
    tails = exact_quantiles(pairs.withColumn("_err", F.abs(F.col("actual") - F.col("predicted"))), group, "_err", quantiles, weight="_n", few_groups=few_groups)
    return sums.join(tails, group)


def order_cost(metrics: DataFrame, under_cost: float = 3.0, over_cost: float = 1.0) -> DataFrame:
    cost = F.col("underforecast_units") * under_cost + F.col("overforecast_units") * over_cost
    return metrics.withColumn("weighted_order_cost", cost).withColumn(
        "weighted_order_cost_rate", safe_ratio(cost, F.col("actual_sum"))
    )


def best_by_segment(metrics: DataFrame, segment: str = "demand_segment") -> DataFrame:
    """The model with the lowest WAPE per segment; ties go to the first name."""
    rest = [c for c in metrics.columns if c != segment]
    picked = metrics.filter(F.col("wape").isNotNull()).groupBy(segment).agg(
        F.min_by(F.struct(*rest), F.struct("wape", "model")).alias("b")
    )
    return picked.select(segment, *[F.col(f"b.{c}").alias(c) for c in rest])


def calibration_factors(scored: DataFrame, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Clamped ratio of actual to predicted totals per model and segment."""
    ratio = F.coalesce(safe_ratio(F.sum("actual"), F.sum("predicted")), F.lit(1.0))
    return scored.groupBy("model", "demand_segment").agg(
        F.least(F.lit(high), F.greatest(F.lit(low), ratio)).alias("calibration_factor")
    )
