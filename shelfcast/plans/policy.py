"""From latest features to store forecasts: future rows, scoring rules, allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import is_weekend, safe_ratio, weekday
from shelfcast.operators.keyed import latest_per_key


def future_features(
    training: DataFrame, keys: list[str], horizon: int = 5, anchor: str = "latest", run_date: Column | None = None,
    default_event_days: int = 0,
) -> DataFrame:
    """The newest row of every series moved 1..horizon days ahead.

    ``anchor="latest"`` counts from the newest feature date of the series,
    ``"run_date"`` from the given date.
    """
    newest = latest_per_key(training, keys, ["feature_date"])
    step = F.col("step")
    start = F.col("feature_date") if anchor == "latest" else run_date
    target = F.date_add(start, step)
    moved = {
        "target_date": target,
        "holiday_flag": F.lit(0),
        "day_of_week": weekday(target),
        "month": F.month(target).cast("bigint"),
        "weekend_flag": is_weekend(target).cast("int"),
        "event_nearby_days": F.greatest(F.coalesce("event_nearby_days", F.lit(default_event_days)) - step, F.lit(0)),
        "book_age_days": F.coalesce("book_age_days", F.lit(0)) + step,
    }
    if "days_since_last_stockout" in training.columns:
        moved["days_since_last_stockout"] = F.coalesce("days_since_last_stockout", F.lit(0)) + step
    ahead = newest.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return ahead.withColumns(moved).drop("step", "feature_date")


def policy_base(model_score: Column, model_segments=("high", "medium"), medium: str = "model", low: str = "ma28") -> Column:
    """Model score for the model segments, moving averages for the others, never negative."""
    segment = F.coalesce("demand_segment", F.lit("low"))

    def average(rule):
        return F.coalesce(F.col("qty_rolling_7d" if rule == "ma7" else "qty_rolling_28d"), F.lit(0.0))

    chosen = (
        F.when(segment.isin(*model_segments), F.greatest(model_score, F.lit(0.0)))
        .when(segment == "medium", average(medium))
        .when(segment == "low", average(low))
        .otherwise(average("ma28"))
    )
    return F.greatest(chosen, F.lit(0.0))


def policy_predict(
    rows: DataFrame, model_score: Column, segment_multipliers: dict | None = None, group_rules: list[dict] | None = None, **policy
) -> DataFrame:
    """Adds ``predicted_demand``: the policy base times the matching multipliers.

    Rules are the fixed few of a model file (at most a report's top list), so
    they become part of the expression and need no join.
    """
    value = policy_base(model_score, **policy)
    segment = F.coalesce("demand_segment", F.lit("low"))
    for name, factor in (segment_multipliers or {}).items():
        value = value * F.when(segment == name, float(factor)).otherwise(1.0)
    for rule in group_rules or []:
        if rule["column"] not in rows.columns:
            continue
        hit = (segment == rule["segment"]) & (F.col(rule["column"]).cast("string") == str(rule["value"]))
        value = value * F.when(hit, float(rule["multiplier"])).otherwise(1.0)
    return rows.withColumn("predicted_demand", F.greatest(value, F.lit(0.0)))


def confidence_bounds(rows: DataFrame, multipliers: dict | None = None) -> DataFrame:
    """Plus or minus a quarter; with order multipliers the bounds follow them."""
    p = F.col("predicted_demand")
    low, high = p * 0.75, p * 1.25
    if multipliers:
        segment = F.coalesce("demand_segment", F.lit("low"))
        for name, factor in multipliers.items():
            m = max(float(factor), 1.0)
            low = F.when(segment == name, p / m).otherwise(low)
            high = F.when(segment == name, p * min(1.18, 1 + (m - 1) / 3)).otherwise(high)
    return rows.withColumns({"confidence_low": F.greatest(low, F.lit(0.0)), "confidence_high": F.greatest(high, F.lit(0.0))})


def stores_per_warehouse(store_map: DataFrame, locations: DataFrame) -> DataFrame:
    """Stores with their warehouse and the number of stores it serves."""
    linked = (
        store_map.select("store_id", "location_id")
        .join(locations, "location_id")
        .filter(F.col("location_type").startswith("STORE") & F.col("wh_id").isNotNull())
        .select("store_id", F.col("wh_id").cast("bigint").alias("wh_id"))
        .distinct()
    )
    counts = linked.groupBy("wh_id").agg(F.count("*").alias("store_count"))
    return linked.join(counts, "wh_id").select(F.col("store_id").cast("bigint").alias("store_id"), "wh_id", "store_count")


def recent_store_sales(sales: DataFrame, stores: DataFrame, since: Column) -> DataFrame:
    sold = sales.filter(F.col("sale_date") >= since).groupBy("isbn13", "store_id").agg(F.sum("qty_sold").alias("store_qty"))
    return sold.join(stores.select("store_id", "wh_id"), "store_id")


def demand_shares(series: DataFrame, stores: DataFrame, recent: DataFrame, mode: str = "normalized", copies: int = 1) -> DataFrame:
    """Share of each store in the demand of its warehouse, per book.

    ``normalized``: shares of recent sales; equal shares only where no store of
    the warehouse sold the book, so shares always add up to 1.
    ``as_written``: equal share for every store without sales, even next to
    stores with sales, and ``copies`` times as much of it, which is what the
    original statement computes by repeating the book once per target date.
    """
    totals = recent.groupBy("isbn13", "wh_id").agg(F.sum("store_qty").alias("_total"))
    rows = (
        series.join(stores, "wh_id")
        .join(recent.select("isbn13", "store_id", "store_qty"), ["isbn13", "store_id"], "left")
        .join(totals, ["isbn13", "wh_id"], "left")
    )
    even = 1.0 / F.col("store_count")
    part = safe_ratio("store_qty", "_total")
    if mode == "normalized":
        share = F.when(F.coalesce("_total", F.lit(0)) > 0, F.coalesce(part, F.lit(0.0))).otherwise(even)
    else:
        share = F.coalesce(part, even * copies)
    return rows.select("isbn13", "wh_id", "store_id", share.alias("demand_share"))


def allocate_to_stores(
    forecasts: DataFrame, sales: DataFrame, store_map: DataFrame, locations: DataFrame, since: Column,
    mode: str = "normalized", horizon: int = 5,
) -> DataFrame:
    """Warehouse forecasts split over the stores of the warehouse."""
    stores = stores_per_warehouse(store_map, locations)
    recent = recent_store_sales(sales, stores, since)
    series = forecasts.select("isbn13", "wh_id").distinct()
    shares = demand_shares(series, stores, recent, mode, horizon if mode == "as_written" else 1)
    values = ["predicted_demand", "confidence_low", "confidence_high"]
    return (
        forecasts.join(shares, ["isbn13", "wh_id"])
        .groupBy("prediction_date", "target_date", "isbn13", "store_id")
        .agg(*[F.sum(F.col(v) * F.col("demand_share")).alias(v) for v in values])
    )


def roll_up_to_warehouse(forecasts: DataFrame, store_map: DataFrame, locations: DataFrame) -> DataFrame:
    place = store_map.select("store_id", F.col("inventory_location_id").alias("location_id")).join(
        locations.select("location_id", F.col("wh_id").cast("bigint").alias("wh_id")), "location_id"
    )
    return (
        forecasts.join(place.select("store_id", "wh_id"), "store_id")
        .groupBy("wh_id", "isbn13", "target_date", "prediction_date")
        .agg(*[F.sum(c).alias(c) for c in ("predicted_demand", "confidence_low", "confidence_high")])
    )


def append_warehouse_rows(forecasts: DataFrame, locations: DataFrame, digits: int = 2) -> DataFrame:
    """Store rows plus one row per warehouse: the sum of its stores, bounds at 85 and 115 percent."""
    stores = locations.filter(F.col("location_type") != "WH").select(F.col("location_id").alias("store_id"), "wh_id")
    houses = locations.filter(F.col("location_type") == "WH").groupBy("wh_id").agg(F.min("location_id").cast("bigint").alias("_house"))
    total = F.sum(F.coalesce("predicted_demand", F.lit(0.0)))
    summed = (
        forecasts.join(stores, "store_id")
        .groupBy("prediction_date", "target_date", "isbn13", "wh_id")
        .agg(total.alias("t"))
        .join(houses, "wh_id")
        .select(
            "prediction_date", "target_date", "isbn13", F.col("_house").alias("store_id"), F.bround("t", digits).alias("predicted_demand"),
            F.bround(F.col("t") * 0.85, digits).alias("confidence_low"), F.bround(F.col("t") * 1.15, digits).alias("confidence_high"),
            F.lit("wh-aggregate").alias("model_version"),
        )
    )
    return forecasts.select(*summed.columns).unionByName(summed)


def latest_run_slice(forecasts: DataFrame, days: int) -> DataFrame:
    """The newest run, restricted to the last ``days`` days before its last target date."""
    run = forecasts.agg(F.max("prediction_date").alias("d")).scalar()
    newest = forecasts.filter(F.col("prediction_date") == run)
    last = newest.agg(F.max("target_date").alias("d")).scalar()
    return newest.filter(F.col("target_date") >= F.date_sub(last, days)).select(
        F.col("target_date").alias("snapshot_date"), "isbn13", "store_id", "predicted_demand", "confidence_low",
        "confidence_high", "model_version",
    )
