"""Cleansing of raw feeds. Casts never raise: bad text becomes NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.domain import STREAM_STORE_WH
from shelfcast.functions.columns import case_map, first_author, is_isbn13, price_tier, strip_html
from shelfcast.operators.keyed import dedupe_first, latest_per_key


def clean_pos(raw: DataFrame) -> DataFrame:
    """Parse the time, keep one row per transaction, then drop invalid rows.

    Copies are removed before the validity filters, so an invalid first copy
    takes its transaction with it. A copy without a readable time comes last.
    """
    typed = raw.withColumn("ts", F.expr("try_cast(ts AS timestamp)")).withColumn("_no_time", F.col("ts").isNull())
    single = dedupe_first(typed, ["tx_id"], ["_no_time", "ts", "isbn13", "qty"]).drop("_no_time")
    valid = single.filter((F.col("qty") > 0) & is_isbn13("isbn13"))
    return valid.withColumns({"sale_date": F.to_date("ts"), "sale_hour": F.hour("ts")})


def clean_catalog(raw: DataFrame) -> DataFrame:
    """Project, cast and keep the latest valid row per book."""
    ints = {"category_id": "int", "price": "long", "sales_point": "long"}
    typed = raw.filter(is_isbn13("isbn13")).withColumns({c: F.col(c).try_cast(t) for c, t in ints.items() if c in raw.columns})
    return latest_per_key(typed, ["isbn13"], ["synced_at"])


def clean_events(raw: DataFrame) -> DataFrame:
    """Calendar events: renamed location, one row per event."""
    named = raw.withColumnRenamed("location", "event_location")
    wanted = ["event_id", "event_type", "title", "start_date", "end_date", "event_location", "isbn13_list", "synced_at"]
    return dedupe_first(named.select(*[c for c in wanted if c in named.columns]), ["event_id"], ["event_type", "start_date"])


def clean_sns(raw: DataFrame, spike_threshold: int = 10) -> DataFrame:
    """Mentions: validity filter first, then one row per mention."""
    count = F.col("mention_count").try_cast("int")
    typed = raw.filter(is_isbn13("isbn13")).select(
        "mention_id",
        "isbn13",
        "platform",
        count.alias("mention_count"),
        F.col("sentiment_score").try_cast("double").alias("sentiment_score"),
        F.expr("try_cast(collected_at AS timestamp)").alias("collected_at"),
    )
    marked = typed.withColumns({"mention_date": F.to_date("collected_at"), "is_spike_seed": F.col("mention_count") >= spike_threshold})
    return dedupe_first(marked, ["mention_id"], ["collected_at"])


def normalize_pos(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Sales rows out of loosely filled records, with the default chains of the feed."""

    def field(name, kind="bigint"):
        return F.col(name).try_cast(kind) if name in records.columns else F.lit(None).cast(kind)

    qty, price = field("qty"), F.coalesce(field("unit_price"), F.lit(0))
    stamp = F.coalesce(field("ts", "timestamp"), field("event_ts", "timestamp"), now if now is not None else F.current_timestamp())
    return records.select(
        F.col("tx_id").alias("txn_id"),
        stamp.alias("event_ts"),
        field("location_id").alias("store_id"),
        F.coalesce(field("wh_id"), F.lit(1)).alias("wh_id"),
        F.coalesce(field("channel", "string"), F.lit("OFFLINE")).alias("channel"),
        "isbn13",
        qty.alias("qty"),
        price.alias("unit_price"),
        F.coalesce(field("discount"), F.lit(0)).alias("discount"),
        F.coalesce(field("total_price"), field("revenue"), qty * price).alias("revenue"),
        field("payment_method", "string").alias("payment_method"),
    )


def stream_warehouse(store: str = "store_id") -> dict[str, Column]:
    """Warehouse by the fixed store map (default 1)."""
    return {"wh_id": case_map(store, STREAM_STORE_WH, 1).cast("bigint")}


def author_table(books: DataFrame) -> DataFrame:
    """Distinct first authors; ids come from the name, so they do not depend on row order."""
    named = books.select(first_author("author").alias("name"), "author_past_books_count")
    return named.groupBy("name").agg(F.max("author_past_books_count").alias("past_books_count")).withColumn(
        "author_id", F.md5("name")
    )


def publisher_table(books: DataFrame) -> DataFrame:
    return books.select(F.coalesce("publisher", F.lit("(unknown)")).alias("name")).distinct().withColumn(
        "publisher_id", F.md5("name")
    )


def cut_to_widths(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Export step for a target with narrow text columns; the mart itself keeps whole texts."""
    return df.withColumns({c: F.substring(c, 1, n) for c, n in widths.items()})


CATALOG_ITEM = (
    "isbn13 STRING, title STRING, author STRING, publisher STRING, pubDate STRING, categoryId STRING, categoryName STRING, "
    "priceStandard STRING, priceSales STRING, salesPoint STRING, cover STRING, description STRING, subInfo STRUCT<itemPage: STRING>"
)


def parse_catalog_items(raw: DataFrame, json: str = "item") -> DataFrame:
    """Catalog items as JSON text into book rows, with the feed's defaults; texts stay whole."""
    item = raw.select(F.from_json(json, CATALOG_ITEM).alias("i")).select("i.*")

    def number(name):
        return F.nullif(F.col(name).try_cast("bigint"), F.lit(0))

    standard = F.coalesce(number("priceStandard"), F.lit(15_000))
    points = F.coalesce(number("salesPoint"), F.lit(0))
    author = F.nullif(F.trim(F.split(F.trim(F.coalesce("author", F.lit(""))), r"\(").getItem(0)), F.lit(""))
    return item.select(
        F.coalesce("isbn13", F.lit("")).alias("isbn13"),
        "title",
        F.coalesce(author, F.lit("(unknown)")).alias("author"),
        "publisher",
        F.col("pubDate").try_cast("date").alias("pub_date"),
        F.coalesce(number("categoryId"), F.lit(0)).alias("category_id"),
        F.col("categoryName").alias("category_name"),
        standard.alias("price_standard"),
        F.coalesce(number("priceSales"), standard).alias("price_sales"),
        price_tier(standard).alias("price_tier"),
        F.coalesce("cover", F.lit("")).alias("cover_url"),
        strip_html(F.coalesce("description", F.lit(""))).alias("description"),
        points.alias("sales_point"),
        number("subInfo.itemPage").alias("item_page"),
        (points >= 50_000).alias("is_bestseller_flag"),
    )


def first_seen(items: DataFrame, order: list[str]) -> DataFrame:
    """First occurrence of every 13-character ISBN over the ordered query lists."""
    trimmed = items.withColumn("isbn13", F.trim("isbn13")).filter(F.length("isbn13") == 13)
    return dedupe_first(trimmed, ["isbn13"], order)


def deactivate_unpriced(books: DataFrame, reason: str = "AUTO_DEACTIVATE_NULL_PRICE") -> DataFrame:
    """Switch off active books requested by a publisher that have no price; idempotent."""
    hit = (F.col("source") == "PUBLISHER_REQUEST") & F.col("price_sales").isNull() & F.col("active")
    old_mode = F.col("discontinue_mode") if "discontinue_mode" in books.columns else F.lit(None).cast("string")
    old_reason = F.col("discontinue_reason") if "discontinue_reason" in books.columns else F.lit(None).cast("string")
    return books.withColumns(
        {
            "discontinue_mode": F.when(hit, F.coalesce(old_mode, F.lit("NONE"))).otherwise(old_mode),
            "discontinue_reason": F.when(hit, F.lit(reason)).otherwise(old_reason),
            "active": F.col("active") & ~F.coalesce(hit, F.lit(False)),
        }
    )


def remap_with_clones(df: DataFrame, key: str, mapping: dict, clones: dict, others: str = "keep", also: dict | None = None) -> DataFrame:
    """Renumber ``key`` and add copies of some old keys under new ones, in one pass.

    ``clones`` maps an old key to the new key that starts as its copy, ``also``
    sets further columns by their own old-key mapping, and ``others`` says
    whether keys without a mapping stay ("keep") or go ("drop").
    """
    old = F.col(key)
    fields = {key: case_map(key, mapping, old if others == "keep" else None).cast("bigint")}
    copy = {key: case_map(key, clones, None).cast("bigint")}
    for name, (by_old, by_clone) in (also or {}).items():
        fields[name] = case_map(key, by_old, F.col(name)).cast("bigint")
        copy[name] = case_map(key, by_clone, None).cast("bigint")

    def row(cols):
        return F.struct(*[c.alias(n) for n, c in cols.items()])

    is_copied = old.isin(*clones)
    rows = F.when(is_copied, F.array(row(fields), row(copy))).otherwise(F.array(row(fields)))
    out = df.withColumn("_r", F.explode(rows)).drop(*fields)
    out = out.select(*[F.col(f"_r.{c}").alias(c) if c in fields else F.col(c) for c in df.columns])
    return out if others == "keep" else out.filter(F.col(key).isNotNull())


def remap_isbn(df: DataFrame, mapping: DataFrame, keys: list[str]) -> DataFrame:
    """Replace ``isbn13`` through (old_isbn, new_isbn), drop unmapped rows, one row per new key.

    Where several old books become one new book, the smallest value of each
    column is taken, which makes the choice repeatable.
    """
    renamed = df.join(mapping, df["isbn13"] == mapping["old_isbn"]).drop("isbn13", "old_isbn").withColumnRenamed("new_isbn", "isbn13")
    rest = [c for c in df.columns if c not in keys]
    return renamed.groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest])


def within_days(df: DataFrame, day: str, days: int, run_date: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``run_date``, or before the newest row."""
    end = run_date if run_date is not None else df.agg(F.max(day).alias("d")).scalar()
    return df.filter(F.col(day) >= F.date_sub(end, days))


def expand_history(sales: DataFrame) -> DataFrame:
    """Daily totals as one realtime-like row each; rows without a quantity are left out."""
    qty, revenue = F.coalesce("qty_sold", F.lit(0)), F.coalesce("revenue", F.lit(0))
    price = F.coalesce(F.nullif("avg_price", F.lit(0)), F.call_function("div", revenue, qty))
    return sales.filter(qty > 0).select(
        F.md5(F.concat_ws("#", "sale_date", "isbn13", "store_id", "channel")).alias("txn_id"),
        (F.col("sale_date").cast("timestamp") + F.expr("INTERVAL 3 HOUR")).alias("event_ts"),
        "store_id",
        F.coalesce("wh_id", F.lit(1)).alias("wh_id"),
        F.coalesce("channel", F.lit("offline")).alias("channel"),
        "isbn13",
        qty.alias("qty"),
        price.alias("unit_price"),
        F.lit(0).cast("bigint").alias("discount"),
        revenue.alias("revenue"),
    )


def union_all_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
