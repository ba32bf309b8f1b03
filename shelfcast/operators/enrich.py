"""Joins of facts with dimensions and with each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def training_view(sales: DataFrame, features: DataFrame, books: DataFrame, locations: DataFrame, inventory: DataFrame) -> DataFrame:
    """Star join of sales with covariates, books, locations and same-day stock."""
    place = locations.select(F.col("location_id").cast("bigint").alias("store_id"), "location_type", F.col("wh_id").alias("_wh"), "size", "is_virtual")
    stock = inventory.select(
        "isbn13", F.col("snapshot_date").alias("sale_date"), F.col("location_id").alias("store_id"), "on_hand", "reserved_qty"
    )
    book = books.select("isbn13", "category_id", "category_name", "publisher", "author", "price_tier", "sales_point", "item_page")
    return (
        sales.select("sale_date", "isbn13", "store_id", "qty_sold")
        .join(features.withColumnRenamed("feature_date", "sale_date"), ["isbn13", "sale_date"], "left")
        .join(book, "isbn13", "left")
        .join(place, "store_id", "left")
        .join(stock, ["isbn13", "sale_date", "store_id"], "left")
        .select(
            "sale_date", "isbn13", "store_id", "qty_sold", "category_id", "category_name", "publisher", "author", "price_tier",
            "sales_point", "item_page", "location_type", F.col("_wh").alias("wh_id"), "size", "is_virtual", "is_holiday", "season",
            "day_of_week", "is_weekend", "month", "event_nearby_days", "sns_mentions_1d", "sns_mentions_7d", "on_hand_total",
            "days_since_last_stockout", "book_age_days", "is_bestseller_flag", "on_hand", "reserved_qty",
        )
    )


def available(on_hand="on_hand", reserved="reserved_qty") -> Column:
    return F.greatest(F.col(on_hand) - F.col(reserved), F.lit(0))


def inventory_available(inventory: DataFrame, locations: DataFrame) -> DataFrame:
    """Free stock at active locations."""
    place = locations.filter("active").select("location_id", "location_type", "wh_id", F.col("name").alias("location_name"))
    return inventory.join(place, "location_id").withColumn("available", available())


def online_available(inventory: DataFrame, locations: DataFrame) -> DataFrame:
    """Stock an online store can sell: that of the warehouse of its region.

    The pairs of places are fixed rows, so they are what is sent to the tasks, whatever size a plan gives the stock.
    """
    online = locations.filter("location_type = 'STORE_ONLINE' AND is_virtual AND active").select(
        "wh_id", F.col("location_id").alias("online_location_id"), F.col("name").alias("online_location_name")
    )
    houses = locations.filter("location_type = 'WH'").select("wh_id", F.col("location_id").alias("wh_location_id"))
    pairs = online.join(houses, "wh_id")
    return inventory.join(F.broadcast(pairs), inventory["location_id"] == pairs["wh_location_id"]).select(
        "online_location_id", "online_location_name", "wh_id", "wh_location_id", "isbn13", available().alias("available")
    )


def count_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose ``key`` is missing in ``parent``.

    Child rows are counted per key before the join, so a heavy key moves as one row.
    """
    per_key = child.groupBy(key).agg(F.count("*").alias("_n"))
    lost = per_key.join(parent.select(key).distinct(), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))


def stock_location(sales: DataFrame, locations: DataFrame) -> DataFrame:
    """Adds the location a sale is debited from: online stores use their warehouse."""
    houses = locations.filter("location_type = 'WH'").groupBy("wh_id").agg(F.min("location_id").alias("_house"))
    source = locations.join(houses, "wh_id", "left").select(
        F.col("location_id").cast("bigint").alias("store_id"),
        F.when(F.col("location_type") == "STORE_ONLINE", F.col("_house")).otherwise(F.col("location_id")).cast("bigint").alias("debit_location_id"),
    )
    return sales.join(source, "store_id", "left").withColumn("debit_location_id", F.coalesce("debit_location_id", "store_id"))


def new_book_candidates(features: DataFrame, inventory: DataFrame, store_map: DataFrame, run_date: Column) -> DataFrame:
    """Every book with covariates on the run date, in every store, with the stock it can draw on."""
    slot = F.struct(F.col("store_id").cast("bigint").alias("store_id"), F.col("inventory_location_id").cast("bigint").alias("location_id"))
    store = store_map.agg(F.sort_array(F.collect_list(slot)).alias("s")).scalar()
    day = features.filter(F.col("feature_date") == run_date).withColumn("s", F.explode(store))
    stock = inventory.filter(F.col("snapshot_date") == run_date).select("isbn13", "location_id", "on_hand")
    return (
        day.select("*", "s.store_id", "s.location_id")
        .join(stock, ["isbn13", "location_id"], "left")
        .select(
            "isbn13", "store_id", "day_of_week", "month",
            F.coalesce("on_hand", F.lit(0)).alias("on_hand"),
            F.coalesce("is_holiday", F.lit(False)).cast("int").alias("holiday_flag"),
            F.coalesce("event_nearby_days", F.lit(0)).alias("event_nearby_days"),
            F.coalesce("sns_mentions_1d", F.lit(0)).alias("sns_mentions_1d"),
            F.coalesce("sns_mentions_7d", F.lit(0)).alias("sns_mentions_7d"),
        )
    )


BATCH_INPUT = [
    "isbn13", "store_id", "day_of_week", "month", "on_hand", "holiday_flag", "event_nearby_days", "sns_mentions_1d", "sns_mentions_7d",
]


def batch_input(candidates: DataFrame) -> DataFrame:
    """Column contract of batch scoring."""
    return candidates.select(*BATCH_INPUT)


def approvals_of_orders(orders: DataFrame, approvals: DataFrame) -> DataFrame:
    return orders.select("order_id", "order_type", "status").join(approvals, "order_id")


def approval_state(orders: DataFrame, approvals: DataFrame) -> DataFrame:
    """Whether every side an order type needs has approved."""
    two_sided = F.col("order_type").isin("WH_TRANSFER", "REBALANCE")
    yes = F.col("decision") == "APPROVED"
    given = approvals.groupBy("order_id").agg(
        F.max(F.when(yes & (F.col("approval_side") == "SOURCE"), 1).otherwise(0)).alias("_s"),
        F.max(F.when(yes & (F.col("approval_side") == "TARGET"), 1).otherwise(0)).alias("_t"),
        F.max(F.when(yes, 1).otherwise(0)).alias("_any"),
    )
    ready = F.when(two_sided, (F.col("_s") == 1) & (F.col("_t") == 1)).otherwise(F.col("_any") == 1)
    return (
        orders.select("order_id", "order_type", "status")
        .join(given, "order_id", "left")
        .select(
            "order_id", "order_type", "status",
            F.when(two_sided, 2).otherwise(1).alias("sides_required"),
            F.when(two_sided, F.coalesce(F.col("_s") + F.col("_t"), F.lit(0))).otherwise(F.coalesce("_any", F.lit(0))).alias("sides_approved"),
            F.coalesce(ready, F.lit(False)).alias("is_ready"),
        )
    )


def without_recent(candidates: DataFrame, history: DataFrame, key: str, at: str, minutes: int = 30) -> DataFrame:
    """Candidates whose key has no earlier event in the cooldown before them.

    Both sides are put into time buckets as long as the cooldown; an event can
    only matter in its own bucket and the next, so the join is on equality and
    one key with a long history spreads over its buckets.
    """
    width = minutes * 60
    bucket = F.floor(F.unix_timestamp(at) / width)
    past = (
        history.select(F.col(key).alias("_k"), F.col(at).alias("_at"), bucket.alias("_b"))
        .withColumn("_b", F.explode(F.array(F.col("_b"), F.col("_b") + 1)))
        .groupBy("_k", "_b", "_at")
        .agg(F.lit(1).alias("_one"))
    )
    right = candidates.withColumn("_bucket", bucket)
    gap = F.expr(f"INTERVAL {minutes} MINUTES")
    on = (
        (right[key] == past["_k"])
        & (right["_bucket"] == past["_b"])
        & (past["_at"] < right[at])
        & (past["_at"] > right[at] - gap)
    )
    return right.join(past, on, "left_anti").drop("_bucket")


def tracked_counts(baselines: DataFrame, counts: DataFrame) -> DataFrame:
    """Mention counts of the tracked books; books without mentions count 0."""
    return baselines.join(counts, "isbn13", "left").withColumn("mentions_count", F.coalesce("mentions_count", F.lit(0)))

