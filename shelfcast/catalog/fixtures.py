"""Adapters from the test tables to the domain tables the operators work on."""

from __future__ import annotations

from datetime import timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.domain import HOLIDAYS, store_location_map
from shelfcast.functions.columns import case_map, price_tier
from shelfcast.operators.calendar import calendar_table, holiday_dates
from shelfcast.operators.features import build_daily_features, build_features


_FRAMES: dict = {}


def once(make):
    """Build a frame's plan once per session and folder; frames hold no data."""

    @wraps(make)
    def frame(spark: SparkSession, sf: str, *name: str):
        folder = str(sf).rstrip("/")
        key = (spark.sparkContext.applicationId, id(spark), folder, make.__name__, *name)
        if key not in _FRAMES:
            _FRAMES[key] = make(spark, folder, *name)
        return _FRAMES[key]

    return frame


@once
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def isbn(c) -> F.Column:
    return F.concat(F.lit("978"), F.lpad(F.col(c).cast("string"), 10, "0"))


@once
def sales_lines(spark, sf) -> DataFrame:
    store = F.col("l_suppkey") % 14 + 1
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("txn_id"),
        F.col("l_partkey").alias("partkey"),
        isbn("l_partkey").alias("isbn13"),
        F.to_date("l_shipdate").alias("sale_date"),
        store.alias("store_id"),
        F.when((store <= 6) | (store == 13), 1).otherwise(2).cast("bigint").alias("wh_id"),
        F.when(store >= 13, "online").otherwise("offline").alias("channel"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint").alias("revenue"),
    )


@once
def sales_fact(spark, sf) -> DataFrame:
    return (
        sales_lines(spark, sf)
        .groupBy("sale_date", "isbn13", "store_id", "wh_id", "channel")
        .agg(F.sum("qty").alias("qty_sold"), F.sum("revenue").alias("revenue"), F.count("*").alias("tx_count"))
        .withColumn("avg_price", F.expr("revenue div qty_sold"))
        .select("sale_date", "isbn13", "store_id", "wh_id", "channel", "qty_sold", "revenue", "avg_price", "tx_count")
    )


@once
def books_static(spark, sf) -> DataFrame:
    key = F.col("p_partkey")
    shift = (key % 5 - 2) * 4000
    standard = F.floor(F.col("p_retailprice") * 20) + shift
    point = key * 37 % 100000
    author = (
        F.when(key % 17 == 0, F.lit(None))
        .when(key % 3 == 0, F.concat_ws(", ", "p_name", "p_type"))
        .when(key % 3 == 1, F.concat_ws("; ", "p_name", "p_brand"))
        .otherwise(F.col("p_name"))
    )
    return table(spark, sf, "part").select(
        key.alias("partkey"),
        isbn("p_partkey").alias("isbn13"),
        F.col("p_name").alias("title"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.col("p_brand").alias("publisher"),
        author.alias("author"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 1500).cast("int")).alias("pub_date"),
        standard.alias("price_standard"),
        F.when(key % 29 != 0, F.floor(F.col("p_retailprice") * 18) + shift).alias("price_sales"),
        price_tier(standard).alias("price_tier"),
        point.alias("sales_point"),
        (point >= 50000).alias("is_bestseller_flag"),
        (key % 40).alias("author_experience_years"),
        (key % 12).alias("author_past_books_count"),
        (90 + key % 700).alias("item_page"),
        F.when(key % 7 == 0, "PUBLISHER_REQUEST").otherwise("CATALOG").alias("source"),
        (key % 11 != 0).alias("active"),
    )


@once
def inventory(spark, sf) -> DataFrame:
    """Current stock: every book at the fourteen places that hold stock."""
    places = F.explode(F.array(*[F.lit(i).cast("bigint") for i in [*range(1, 13), 15, 16]]))
    hand = (F.col("partkey") * 31 + F.col("location_id") * 17) % 200
    return (
        books_static(spark, sf)
        .select("isbn13", "partkey", places.alias("location_id"))
        .select(
            "isbn13",
            "location_id",
            hand.alias("on_hand"),
            (hand % 11).alias("reserved_qty"),
            (5 + F.col("partkey") % 20).alias("safety_stock"),
        )
    )


@once
def inventory_daily(spark, sf) -> DataFrame:
    """A snapshot row wherever and whenever a book was sold."""
    days = F.datediff("snapshot_date", F.lit("1995-01-01").cast("date"))
    hand = (F.col("partkey") * 31 + F.col("location_id") * 17 + days * 7) % 40
    return (
        sales_lines(spark, sf)
        .select("sale_date", "isbn13", "partkey", "store_id")
        .join(store_location_map(spark).drop("location_id"), "store_id")
        .select(
            F.col("sale_date").alias("snapshot_date"),
            "isbn13",
            "partkey",
            F.col("inventory_location_id").cast("bigint").alias("location_id"),
        )
        .distinct()
        .select(
            "snapshot_date",
            "isbn13",
            "location_id",
            hand.alias("on_hand"),
            (hand % 11).alias("reserved_qty"),
            (5 + F.col("partkey") % 20).alias("safety_stock"),
        )
    )


@once
def sale_bounds(spark, sf) -> DataFrame:
    return sales_lines(spark, sf).agg(F.min("sale_date").alias("lo"), F.max("sale_date").alias("hi"))


def sale_days(spark, sf) -> tuple:
    """First and last sale date, looked up now; a run takes its dates as parameters, so they become literals."""
    row = sale_bounds(spark, sf).first()
    return row["lo"], row["hi"]


def newest_sale(spark, sf) -> F.Column:
    return F.lit(sale_days(spark, sf)[1])


def sale_period(spark, sf, last: int | None = None) -> tuple:
    """The whole period with sales, or its last days."""
    lo, hi = sale_days(spark, sf)
    if last is not None:
        lo = max(lo, hi - timedelta(days=last - 1))
    return F.lit(lo), F.lit(hi)


def literal_bounds(spark, sf) -> DataFrame:
    lo, hi = sale_days(spark, sf)
    return spark.sql(f"SELECT DATE '{lo}' AS lo, DATE '{hi}' AS hi")


def calendar(spark, sf) -> DataFrame:
    bounds = literal_bounds(spark, sf)
    return calendar_table(bounds, holiday_dates(spark, bounds, HOLIDAYS))


def _copies(df: DataFrame) -> DataFrame:
    """Every fiftieth event arrives twice."""
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("copy_no", F.explode(copies))


def _event_isbn():
    return F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("X"), F.col("user_id").cast("string"))).otherwise(
        isbn("user_id")
    )


def pos_events(events: DataFrame) -> DataFrame:
    """Raw point-of-sale records out of purchase events; batch or stream."""
    qty = (F.col("event_id") + F.col("copy_no")) % 5
    price = F.floor(F.col("value") * 1000)
    store = F.col("user_id") % 14 + 1
    return _copies(events.filter("event_type = 'purchase'")).select(
        F.col("event_id").cast("string").alias("tx_id"),
        _event_isbn().alias("isbn13"),
        qty.cast("int").alias("qty"),
        price.alias("unit_price"),
        (qty * price).alias("total_price"),
        F.when(store >= 13, "online").otherwise("offline").alias("channel"),
        store.cast("int").alias("location_id"),
        F.when(F.col("event_id") % 89 == 0, "not-a-time")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("ts"),
    )


@once
def pos_raw(spark, sf) -> DataFrame:
    return pos_events(table(spark, sf, "events"))


def sns_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin("view", "click")).select(
        F.col("event_id").cast("string").alias("mention_id"),
        _event_isbn().alias("isbn13"),
        F.when(F.col("event_type") == "view", "blog").otherwise("feed").alias("platform"),
        F.get_json_object("props", "$.k").alias("mention_count"),
        F.col("value").alias("sentiment_score"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("collected_at"),
    )


@once
def sns_raw(spark, sf) -> DataFrame:
    return sns_events(table(spark, sf, "events"))


def sns_daily(spark, sf) -> DataFrame:
    """Mentions per book and day, moved into the sales period."""
    first = sale_period(spark, sf)[0]
    return (
        table(spark, sf, "events")
        .filter(F.col("event_type").isin("view", "click"))
        .select(
            isbn("user_id").alias("isbn13"),
            F.date_add(first, (F.col("event_id") % 2499).cast("int")).alias("mention_date"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )
        .groupBy("isbn13", "mention_date")
        .agg(F.sum("k").alias("mentions"))
    )


@once
def catalog_raw(spark, sf) -> DataFrame:
    key = F.col("p_partkey")
    base = F.floor("p_retailprice")
    return (
        table(spark, sf, "part")
        .withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            F.when(key % 97 == 0, F.concat(F.lit("97"), key.cast("string"))).otherwise(isbn("p_partkey")).alias("isbn13"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("publisher"),
            F.col("p_size").cast("string").alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.when((F.col("v") == 1) & (key % 2 == 0), base + 10).otherwise(base).alias("price"),
            (key * 37 % 100000).alias("sales_point"),
            F.when(F.col("v") == 0, "2024-01-01T00:00:00").otherwise("2024-02-01T00:00:00").alias("synced_at"),
        )
    )


@once
def pending_orders(spark, sf) -> DataFrame:
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    status = (
        F.when((state == "P") & (key % 2 == 0), "PENDING")
        .when(state == "P", "APPROVED")
        .when(state == "O", "IN_TRANSIT")
        .otherwise(F.when(key % 3 == 0, "EXECUTED").when(key % 3 == 1, "AUTO_EXECUTED").otherwise("REJECTED"))
    )
    refused = (state == "F") & (key % 3 == 2)
    stage = F.when(refused, F.when(key % 2 == 0, "PENDING").when(key % 5 == 0, "LOST").otherwise("APPROVED"))
    made = F.col("created_at")
    hour = F.expr("INTERVAL 1 HOUR")
    base = table(spark, sf, "orders").select(
        F.concat(F.lit("ord-"), F.lpad(key.cast("string"), 10, "0")).alias("order_id"),
        key.alias("orderkey"),
        case_map(
            "o_orderpriority",
            {"1-URGENT": "PUBLISHER_ORDER", "2-HIGH": "WH_TRANSFER", "3-MEDIUM": "REBALANCE"},
            "WH_TO_STORE",
        ).alias("order_type"),
        isbn("o_custkey").alias("isbn13"),
        (key % 16 + 1).alias("source_location_id"),
        (F.col("o_custkey") % 16 + 1).alias("target_location_id"),
        (1 + F.col("o_custkey") % 50).alias("qty"),
        case_map("o_orderpriority", {"1-URGENT": "CRITICAL", "2-HIGH": "URGENT"}, "NORMAL").alias("urgency_level"),
        status.alias("status"),
        stage.alias("rejection_stage"),
        F.when(refused, "stock_short").alias("reject_reason"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )
    moved = F.col("status").isin("IN_TRANSIT", "EXECUTED", "AUTO_EXECUTED")
    approved = moved | (F.col("status") == "APPROVED") | (F.col("rejection_stage") == "APPROVED")
    plan = F.concat(
        F.lit('{"reason":"demand_growth","expected_arrival_date":"'),
        F.date_format(made + F.expr("INTERVAL 3 DAY"), "yyyy-MM-dd"),
        F.lit('"}'),
    )
    return base.select(
        "*",
        F.when(approved, made + hour).alias("approved_at"),
        F.when(moved & (F.col("orderkey") % 41 != 0), made + F.expr("INTERVAL 2 HOUR")).alias("dispatched_at"),
        F.when(
            F.col("status").isin("EXECUTED", "AUTO_EXECUTED") & (F.col("orderkey") % 43 != 0),
            made + F.expr("INTERVAL 3 HOUR"),
        ).alias("executed_at"),
        F.when(F.col("orderkey") % 4 == 0, "{}").otherwise(plan).alias("forecast_rationale"),
    )


@once
def order_approvals(spark, sf) -> DataFrame:
    def side(name, hours):
        return F.struct(F.lit(name).alias("side"), F.lit(hours).alias("hours"))

    both = F.array(side("SOURCE", 1), side("TARGET", 2))
    late = (F.col("s.side") == "TARGET") & (F.col("orderkey") % 7 == 0)
    return (
        pending_orders(spark, sf)
        .filter(F.col("status").isin("APPROVED", "REJECTED", "AUTO_EXECUTED"))
        .withColumn(
            "s",
            F.explode(F.when(F.col("order_type").isin("WH_TRANSFER", "REBALANCE"), both).otherwise(F.array(side("SINGLE", 1)))),
        )
        .filter(~late)
        .select(
            "order_id",
            F.col("s.side").alias("approval_side"),
            F.when(F.col("status") == "REJECTED", "REJECTED").otherwise("APPROVED").alias("decision"),
            (F.col("created_at") + F.make_dt_interval(hours=F.col("s.hours"))).alias("decided_at"),
        )
    )


def forecast_results(spark, sf) -> DataFrame:
    """Two forecast runs of five days; the older run has faulty rows."""
    last = newest_sale(spark, sf)
    runs = F.explode(F.array(F.lit(0), F.lit(1)))
    steps = F.explode(F.sequence(F.lit(1), F.lit(5)))
    value = F.col("demand") + F.col("step") * 0.25
    old = F.col("run") == 1
    return (
        sales_lines(spark, sf)
        .groupBy("isbn13", "partkey", "store_id")
        .agg((F.sum("qty") % 40 / F.lit(4.0)).alias("demand"))
        .withColumn("run", runs)
        .withColumn("step", steps)
        .withColumn("prediction_date", F.date_sub(last, F.col("run")))
        .select(
            "prediction_date",
            F.date_add("prediction_date", F.col("step")).alias("target_date"),
            "isbn13",
            "store_id",
            F.when(old & (F.col("partkey") % 101 == 0), F.lit(None))
            .when(old & (F.col("partkey") % 103 == 0), F.lit(-1.0))
            .otherwise(value)
            .alias("predicted_demand"),
            F.when(old & (F.col("partkey") % 107 == 0), F.col("demand") * 2 + 9).otherwise(value * 0.75).alias("confidence_low"),
            (value * 1.25).alias("confidence_high"),
            F.concat(F.lit("store-demand-v"), (2 - F.col("run")).cast("string"), F.lit("-catalog-retrained-weekly")).alias(
                "model_version"
            ),
        )
    )


def features(spark, sf) -> DataFrame:
    spine = sales_lines(spark, sf).select("isbn13", F.col("sale_date").alias("feature_date")).distinct()
    return build_features(
        spine, calendar(spark, sf), books_static(spark, sf), sns_daily(spark, sf), inventory_daily(spark, sf)
    )


def book_features(spark, sf) -> DataFrame:
    """Covariates of every book on every day of the sales period."""
    return build_daily_features(
        books_static(spark, sf), *sale_period(spark, sf), calendar(spark, sf), sns_daily(spark, sf), inventory_daily(spark, sf)
    )
