"""Baseline forecasts scored on the last days of a dense panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import safe_ratio
from shelfcast.operators.quantiles import exact_quantiles
from shelfcast.operators.scoring import calibration_factors, error_metrics, stack_models
from shelfcast.operators.series import (
    last_days,
    with_intermittent_stats,
    with_lags,
    with_rolling_means,
)
from shelfcast.session import through_disk


def zero(c):
    return F.coalesce(c, F.lit(0.0))


def recent_panel(panel: DataFrame, days: int, lead_in: int, newest: Column | None = None) -> DataFrame:
    """Only the days a backtest looks at: the scored days and the lead-in of their windows."""
    return last_days(panel, "feature_date", days + lead_in, newest)


#: Windows of a panel that brings the baselines, and the intermittent ones, along; they need no sort of its dense rows.
BASELINES = dict(lags=(7,), spans=(7, 28), lag_prefix="lag_", mean_prefix="ma_")
INTERMITTENT = dict(**BASELINES, lookback=56)


def with_baselines(panel: DataFrame, keys: list[str], value: str = "qty_sold") -> DataFrame:
    """The baselines of every day; a panel built with the windows of ``BASELINES`` has them."""
    if {"ma_7d", "ma_28d", "lag_7"} <= set(panel.columns):
        return panel
    rolled = with_rolling_means(panel, keys, "feature_date", value, prefix="ma_")
    return with_lags(rolled, keys, "feature_date", value, lags=(7,), prefix="lag_")


def baseline_scores(
    panel: DataFrame, keys: list[str], holdout_days: int = 28, value: str = "qty_sold", newest: Column | None = None, keep: list[str] = (),
    counted: bool = False,
) -> DataFrame:
    """Moving averages and the same weekday of last week, one scored row per model.

    ``counted`` gives rows that are equal in the value and all forecasts once, with their number as ``_n``.
    """
    base = with_baselines(recent_panel(panel, holdout_days, 28, newest), keys, value)
    held = last_days(base, "feature_date", holdout_days, newest)
    models = {"ma_7d": zero("ma_7d"), "ma_28d": zero("ma_28d"), "same_weekday": zero("lag_7")}
    if counted:
        held = held.groupBy(*keep, value, "ma_7d", "ma_28d", "lag_7").agg(F.count("*").alias("_n"))
    return stack_models(held, models, [*keep, "_n"] if counted else list(keep), value)


def baseline_backtest(panel: DataFrame, keys: list[str], holdout_days: int = 28, value: str = "qty_sold", newest: Column | None = None) -> DataFrame:
    scored = baseline_scores(panel, keys, holdout_days, value, newest)
    return error_metrics(scored, ["model"], {"p50_abs_error": 0.5, "p90_abs_error": 0.9}, few_groups=True)


def intermittent_inputs(panel: DataFrame, keys: list[str], holdout_days: int, lookback: int, newest: Column | None = None) -> DataFrame:
    if newest is None:
        newest = panel.agg(F.max("feature_date").alias("d")).scalar()
    recent = recent_panel(panel, 2 * holdout_days, max(lookback, 28), newest)
    base = with_baselines(recent, keys)
    if "nonzero_mean_qty" not in panel.columns:  # else built with the windows of ``INTERMITTENT``
        base = with_intermittent_stats(base, keys, "feature_date", "qty_sold", lookback)
    expected = zero("nonzero_mean_qty") * zero("nonzero_probability")
    both = last_days(base.withColumn("expected", expected), "feature_date", 2 * holdout_days, newest)
    part = F.when(F.col("feature_date") > F.date_sub(newest, holdout_days), "holdout").otherwise("calibration")
    return both.withColumn("part", part)


def intermittent_scores(
    panel: DataFrame, keys: list[str], holdout_days: int = 14, lookback: int = 56, newest: Column | None = None
):
    """Scored rows of the eight intermittent-demand baselines, and the factors used.

    The windows are computed once: their days are written, the factors come from the first half and scale the second.
    """
    base = intermittent_inputs(panel, keys, holdout_days, lookback, newest)
    base = through_disk(panel.sparkSession, base.select("part", "demand_segment", "qty_sold", "ma_7d", "ma_28d", "lag_7", "expected"), "intermittent")
    plain = {"ma_7d": zero("ma_7d"), "ma_28d": zero("ma_28d"), "intermittent_probability_mean": F.col("expected")}
    keep = ["demand_segment"]
    factors = calibration_factors(stack_models(base.filter("part = 'calibration'"), plain, keep, "qty_sold"))
    # One row per segment with the factors of the three models as columns.
    wide = factors.groupBy("demand_segment").agg(*[F.max(F.when(F.col("model") == m, F.col("calibration_factor"))).alias(f"factor_{m}") for m in plain])
    held = base.filter("part = 'holdout'").join(F.broadcast(wide), "demand_segment", "left")
    models = {
        **plain,
        "same_weekday": zero("lag_7"),
        "sba_adjusted_intermittent": 0.95 * F.col("expected"),
        **{f"calibrated_{m}": c * F.coalesce(f"factor_{m}", F.lit(1.0)) for m, c in plain.items()},
    }
    return stack_models(held, models, keep, "qty_sold"), factors


def intermittent_backtest(
    panel: DataFrame, keys: list[str], holdout_days: int = 14, lookback: int = 56, newest: Column | None = None
) -> DataFrame:
    scored, _ = intermittent_scores(panel, keys, holdout_days, lookback, newest)
    metrics = error_metrics(scored, ["model", "demand_segment"], {"p50_abs_error": 0.5, "p90_abs_error": 0.9}, few_groups=True)
    return metrics.withColumn("passed", F.col("wape") < 1.0)


def uplift(held: DataFrame, name: str, label, reference, extra: str) -> DataFrame:
    """Mean quantity per group over the mean of the reference rows.

    One aggregation gives the sums of both; the reference mean is then a total
    over the handful of groups.
    """
    parts = held.groupBy(label.alias("segment"), reference.alias("_ref")).agg(
        F.count("*").alias("n"), F.sum("qty_sold").alias("q"), F.sum(extra).alias("x")
    )
    base = parts.agg(
        safe_ratio(F.sum(F.when(F.col("_ref"), F.col("q"))), F.sum(F.when(F.col("_ref"), F.col("n")))).alias("m")
    ).scalar()
    return parts.groupBy("segment").agg(
        F.sum("n").alias("row_count"),
        safe_ratio(F.sum("q"), F.sum("n")).alias("metric_1"),
        safe_ratio(safe_ratio(F.sum("q"), F.sum("n")), base).alias("metric_2"),
        safe_ratio(F.sum("x"), F.sum("n")).alias("metric_3"),
    ).select(F.lit(name).alias("check_name"), "segment", "row_count", "metric_1", "metric_2", "metric_3",
             (F.col("row_count") > 0).alias("passed"))


def uplift_checks(held: DataFrame, sns_day: int = 500, sns_week: int = 1000) -> DataFrame:
    """Store size, social mentions, events and bestsellers against their reference rows."""
    loud = (F.col("sns_mentions_1d") >= sns_day) | (F.col("sns_mentions_7d") >= sns_week)
    near = F.col("event_nearby_days").between(0, 2) | (F.col("holiday_flag") == 1)
    best = F.col("bestseller_flag") == 1
    checks = [
        uplift(held, "store_size_uplift", F.col("store_size"), F.lit(True), "on_hand"),
        uplift(held, "sns_uplift", F.when(loud, "high_sns").otherwise("normal_sns"), ~loud, "sns_mentions_1d"),
        uplift(held, "event_uplift", F.when(near, "event_window").otherwise("normal_day"), ~near, "event_nearby_days"),
        uplift(held, "bestseller_uplift", F.when(best, "bestseller").otherwise("non_bestseller"), ~best, "sales_point"),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def feature_screen(
    training: DataFrame, holdout_days: int = 14, sns_day: int = 500, sns_week: int = 1000, newest: Column | None = None
) -> DataFrame:
    """The uplift checks plus the 28-day moving average scored per segment."""
    held = last_days(training, "feature_date", holdout_days, newest)
    scored = stack_models(held, {"baseline_ma28": zero("qty_rolling_28d")}, ["demand_segment"], "qty_sold")
    tails = exact_quantiles(
        scored.withColumn("_e", F.abs(F.col("actual") - F.col("predicted"))), ["demand_segment"], "_e", {"metric_3": 0.9},
        few_groups=True,
    )
    wape = safe_ratio(F.sum(F.abs(F.col("actual") - F.col("predicted"))), F.sum(F.abs("actual")))
    base = (
        scored.groupBy("demand_segment")
        .agg(
            F.count("*").alias("row_count"),
            wape.alias("metric_1"),
            F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("metric_2"),
        )
        .join(tails, "demand_segment")
        .select(F.lit("baseline_ma28").alias("check_name"), F.col("demand_segment").alias("segment"), "row_count",
                "metric_1", "metric_2", "metric_3", (F.col("metric_1") < 1.0).alias("passed"))
    )
    return base.unionByName(uplift_checks(held, sns_day, sns_week))


def segment_multipliers(scored: DataFrame, service_level: float = 0.9, cap: float = 1.35) -> DataFrame:
    """Quantile of actual over predicted per segment, kept between 1 and ``cap``."""
    ratio = F.col("actual") / F.greatest("predicted", F.lit(0.05))
    q = exact_quantiles(
        scored.filter(F.col("demand_segment").isNotNull()).withColumn("_r", ratio), ["demand_segment"], "_r", {"q": service_level},
        few_groups=True,
    )
    return q.select("demand_segment", F.least(F.greatest("q", F.lit(1.0)), F.lit(cap)).alias("multiplier"))


def group_multipliers(
    scored: DataFrame, columns: list[str], service_level: float = 0.9, cap: float = 1.15, min_rows: int = 500, top: int = 24
) -> DataFrame:
    """The same per column value and segment; the ``top`` strongest rules are the report."""
    values = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    ratio = F.col("actual") / F.greatest("predicted", F.lit(0.05))
    # A missing value is a group of its own, as in a grouping that keeps NULL.
    flat = scored.select(F.explode(values).alias("v"), F.coalesce("demand_segment", F.lit("nan")).alias("segment"), ratio.alias("_r")).select(
        F.col("v.name").alias("column"), F.coalesce("v.value", F.lit("nan")).alias("value"), "segment", "_r"
    )
    keys = ["column", "value", "segment"]
    sizes = flat.groupBy(*keys).agg(F.count("*").alias("train_rows")).filter(F.col("train_rows") >= min_rows)
    q = exact_quantiles(flat, keys, "_r", {"q": service_level})
    capped = F.least(F.greatest("q", F.lit(1.0)), F.lit(cap))
    return (
        sizes.join(q, keys)
        .select(*keys, capped.alias("multiplier"), "train_rows")
        .filter("multiplier > 1.001")
        .orderBy(F.desc("multiplier"), F.desc("train_rows"), *keys)
        .limit(top)
    )


def weight_grid(steps: int = 10) -> list[tuple[float, float, float]]:
    return [(a / steps, b / steps, (steps - a - b) / steps) for a in range(steps + 1) for b in range(steps + 1 - a)]


def ensemble_weights(
    rows: DataFrame, members: list[str], min_fill: float = 0.82, min_high_fill: float = 0.82,
    under_cost: float = 3.0, over_cost: float = 1.0,
) -> DataFrame:
    """Cost and rank of every weight mix of three member forecasts.

    ``rows`` has ``actual``, ``demand_segment`` and the member columns. Equal rows
    are counted first. The whole grid is evaluated in one aggregation of the
    counts: the candidates are columns of it, so the input is read once and never
    multiplied.
    """
    grid = weight_grid()
    high, n = F.col("demand_segment") == "high", F.col("_n")
    rows = rows.groupBy("actual", "demand_segment", *members).agg(F.count("*").alias("_n"))
    parts = []
    for i, weights in enumerate(grid):
        mix = sum((F.col(m) * w for m, w in zip(members[1:], weights[1:])), F.col(members[0]) * weights[0])
        diff = F.col("actual") - mix
        under, over = F.greatest(diff, F.lit(0.0)), F.greatest(-diff, F.lit(0.0))
        parts += [
            F.sum(under * n).alias(f"u{i}"),
            F.sum(over * n).alias(f"o{i}"),
            F.sum(F.when(high, under * n)).alias(f"h{i}"),
            F.sum((F.round(mix, 6) < F.col("actual")).cast("bigint") * n).alias(f"c{i}"),
        ]
    total = rows.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.sum(F.col("actual") * n).alias("a"), F.sum(F.when(high, F.col("actual") * n)).alias("ah"), *parts
    )
    cells = F.array(
        *[
            F.struct(
                *[F.lit(w).alias(f"w{k + 1}") for k, w in enumerate(weights)],
                F.col(f"u{i}").alias("u"), F.col(f"o{i}").alias("o"), F.col(f"h{i}").alias("h"), F.col(f"c{i}").alias("c"),
            )
            for i, weights in enumerate(grid)
        ]
    )
    fill = 1 - safe_ratio("g.u", "a")
    high_fill = F.coalesce(1 - safe_ratio("g.h", "ah"), fill)
    rate = safe_ratio(F.col("g.u") * under_cost + F.col("g.o") * over_cost, "a")
    short = F.greatest(F.lit(min_fill) - fill, F.lit(0.0)) + F.greatest(F.lit(min_high_fill) - high_fill, F.lit(0.0))
    mixes = (
        total.select("n", "a", "ah", F.explode(cells).alias("g"))
        .select(
            "g.w1", "g.w2", "g.w3",
            rate.alias("weighted_order_cost_rate"),
            safe_ratio(F.col("g.u") + F.col("g.o"), "a").alias("wape"),
            fill.alias("fill_rate_proxy"),
            safe_ratio("g.c", "n").alias("underforecast_rate"),
            (rate + 10 * short).alias("score"),
        )
    )
    # 66 rows, so the window needs no key; sums of fractions are compared at eight digits
    order = [*[F.round(c, 8) for c in ("score", "weighted_order_cost_rate", "wape")], "w1", "w2"]
    return mixes.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
