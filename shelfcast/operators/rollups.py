"""Grouped summaries of sales, stock and mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.domain import inline_table
from shelfcast.functions.columns import int_div

#: Tasks that rows are dealt to, at least, where grouping reduces little.
DEALT_PARTS = 200


def daily_sales(lines: DataFrame) -> DataFrame:
    """Totals per day, book, store and channel."""
    return lines.groupBy("sale_date", "isbn13", "store_id", "channel").agg(
        F.sum("qty").alias("total_qty"), F.sum("revenue").alias("total_revenue"), F.count("*").alias("tx_count")
    )


def kpi_daily(lines: DataFrame) -> DataFrame:
    """Totals, distinct books, integer average price and best book per day, store and channel.

    Lines are first added up per book. The distinct count is then a plain count
    and the best book a minimum, so neither needs a set or a window.
    """
    per_book = lines.groupBy(F.col("sale_date").alias("kpi_date"), "store_id", "channel", "isbn13").agg(
        F.sum("qty").alias("q"), F.sum("revenue").alias("r"), F.count("*").alias("n")
    )
    return kpi_of_books(per_book, summed=True)


def kpi_of_books(books: DataFrame, summed: bool = False) -> DataFrame:
    """KPIs out of totals per book (q, r, n); ``summed``: a book has one row per day, store and channel already."""
    group = ["kpi_date", "store_id", "channel"]
    if not summed:
        books = books.groupBy(*group, "isbn13").agg(*[F.sum(c).alias(c) for c in ("q", "r", "n")])
    return (
        books.groupBy(*group)
        .agg(
            F.sum("q").alias("qty_sold"),
            F.sum("r").alias("revenue"),
            F.sum("n").alias("tx_count"),
            F.count("*").alias("unique_isbn_count"),
            F.min_by("isbn13", F.struct((-F.col("q")).alias("o"), "isbn13")).alias("top_isbn"),
        )
        .withColumn("avg_price", int_div("revenue", "qty_sold"))
    )


def top_book(lines: DataFrame, group: list[str]) -> DataFrame:
    """The book with the largest quantity per group; ties go to the smaller ISBN."""
    per_book = lines.groupBy(*group, "isbn13").agg(F.sum("qty").alias("q"))
    best = F.min(F.struct((-F.col("q")).alias("o"), "isbn13"))
    return per_book.groupBy(*group).agg(best.alias("b")).select(*group, F.col("b.isbn13").alias("top_isbn"), (-F.col("b.o")).alias("top_qty"))


def with_company_total(lines: DataFrame) -> DataFrame:
    """Store rows plus one company row (store 0) per day, its books counted once however many stores sold them."""
    whole = lines.withColumns({"store_id": F.lit(0).cast("bigint"), "channel": F.lit("ALL")})
    return kpi_daily(lines).unionByName(kpi_daily(whole))


def branch_inventory(inventory: DataFrame, locations: DataFrame) -> DataFrame:
    """Books and units per location; locations without stock stay in the result.

    A book and location has few rows, so grouping before the shuffle would hold most of a task's rows and reduce nothing.
    The rows are dealt first, to a given number of tasks: partitions small in bytes but with many groups are not merged.
    """
    parts = max(DEALT_PARTS, int(inventory.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = inventory.select("location_id", "isbn13", "on_hand").repartition(parts, "location_id", "isbn13")
    per_book = dealt.groupBy("location_id", "isbn13").agg(F.sum("on_hand").alias("q"))
    stock = per_book.groupBy("location_id").agg(F.count("isbn13").alias("distinct_books"), F.sum("q").alias("total_qty"))
    return locations.join(stock, "location_id", "left").select(
        "location_id", F.col("name").alias("location_name"), "region", "location_type",
        F.coalesce("distinct_books", F.lit(0)).alias("distinct_books"), "total_qty",
    )


def top_sellers(daily: DataFrame, n: int = 5) -> DataFrame:
    return (
        daily.groupBy("isbn13").agg(F.sum("total_qty").alias("total_sold")).orderBy(F.desc("total_sold"), "isbn13").limit(n)
    )


def channel_mix(daily: DataFrame) -> DataFrame:
    return daily.groupBy("channel").agg(F.sum("total_revenue").alias("revenue"), F.sum("total_qty").alias("qty"))


def feature_profile(features: DataFrame) -> DataFrame:
    per_book = features.groupBy("isbn13").agg(
        F.count("*").alias("n"), F.sum("sns_mentions_1d").alias("s"), F.sum("on_hand_total").alias("h")
    )
    return per_book.agg(
        F.sum("n").alias("row_count"), F.count("*").alias("isbn_count"),
        F.try_divide(F.sum("s"), F.sum("n")).alias("avg_sns"), F.try_divide(F.sum("h"), F.sum("n")).alias("avg_on_hand_total"),
    )


def spike_seed_profile(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("is_spike_seed").agg(F.count("*").alias("cnt"), F.avg("mention_count").alias("avg_mentions"))


def count_by(df: DataFrame, keys: list[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def order_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_type", "status").agg(F.count("*").alias("order_count"), F.sum("qty").alias("total_qty"))


def order_funnel(orders: DataFrame) -> DataFrame:
    """Rejected, approved, executed and waiting orders per creation day."""
    status = F.col("status")
    return orders.groupBy(F.to_date("created_at").alias("order_date")).agg(
        F.count_if(status == "REJECTED").alias("rejected"),
        F.count_if(status.isin("APPROVED", "IN_TRANSIT")).alias("approved"),
        F.count_if(status.isin("EXECUTED", "AUTO_EXECUTED")).alias("executed"),
        F.count_if(status == "PENDING").alias("pending"),
    )


def check_min_rows(spark: SparkSession, tables: dict[str, DataFrame], minimum: dict[str, int]) -> DataFrame:
    """Row count of every table next to the smallest acceptable one."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()
    ]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    limits = inline_table(spark, list(minimum.items()), ["table_name", "min_rows"])
    return counts.join(limits, "table_name").withColumn("is_enough", F.col("row_count") >= F.col("min_rows"))


def catalog_counts(catalog: DataFrame, top: int = 5) -> DataFrame:
    """The largest publishers with their mean price."""
    return (
        catalog.groupBy("publisher")
        .agg(F.count("*").alias("book_count"), F.avg("price").alias("avg_price"))
        .orderBy(F.desc("book_count"), "publisher")
        .limit(top)
    )


def safety_stock(demand: DataFrame, locations: DataFrame, days: int = 5, floor: int = 5) -> DataFrame:
    """Safety stock per book for stores and, from the sum over their stores, for warehouses."""

    def units(c) -> Column:
        return F.greatest(F.floor(F.col(c) * days).cast("bigint"), F.lit(floor).cast("bigint"))

    physical = locations.filter("NOT is_virtual")
    stores = physical.filter("location_type <> 'WH'").select(F.col("location_id").cast("bigint").alias("store_id"), "wh_id")
    houses = physical.filter("location_type = 'WH'").groupBy("wh_id").agg(F.min("location_id").cast("bigint").alias("location_id"))
    base = demand.join(stores, "store_id")
    store_rows = base.select("isbn13", F.col("store_id").alias("location_id"), units("demand").alias("safety_stock"))
    house_rows = (
        base.groupBy("isbn13", "wh_id").agg(F.sum("demand").alias("demand")).join(houses, "wh_id")
        .select("isbn13", "location_id", units("demand").alias("safety_stock"))
    )
    return store_rows.unionByName(house_rows)


def cross_spikes(lines: DataFrame, since: Column, until: Column, at: str = "event_ts", threshold: float = 2.0) -> DataFrame:
    """Books whose sales count stands out from all books of the window (population z-score)."""
    counts = (
        lines.filter((F.col(at) > since) & (F.col(at) <= until)).groupBy("isbn13").agg(F.count("*").alias("count_w"))
    )
    stats = counts.agg(F.avg("count_w").alias("m"), F.coalesce(F.stddev_pop("count_w"), F.lit(0.0)).alias("s"))
    both = stats.select(F.struct("m", "s")).scalar()
    z = F.try_divide(F.col("count_w") - F.col("mean_w"), F.col("std_w"))
    return (
        counts.select("isbn13", "count_w", both["m"].alias("mean_w"), both["s"].alias("std_w"))
        .withColumn("z_score", z)
        .filter((F.col("std_w") > 0) & (F.col("z_score") >= threshold))
    )


def poisson_spikes(counts: DataFrame, threshold: float = 3.0, default_baseline: float = 5.0, run_ts: Column | None = None) -> DataFrame:
    """z = (n - baseline) / sqrt(baseline) per tracked book, with a first order quantity.

    Both figures are rounded half to even, as the feed's own arithmetic does.
    """
    base = F.coalesce("baseline_lam", F.lit(default_baseline))
    z = F.when(base > 0, (F.col("mentions_count") - base) / F.sqrt(base)).otherwise(F.lit(0.0))
    found = counts.withColumn("_z", z).filter(F.col("_z") >= threshold).withColumn("z_score", F.bround("_z", 2))
    qty = F.least(F.lit(400), F.greatest(F.lit(30), F.bround(F.col("z_score") * 30).cast("int")))
    out = found.select("isbn13", "z_score", "mentions_count", qty.alias("predicted_qty"))
    return out if run_ts is None else out.withColumn("detected_at", run_ts)
