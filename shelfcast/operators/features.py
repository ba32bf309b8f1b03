"""Per day and book covariates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trailing_mentions(daily: DataFrame, days: int = 7) -> DataFrame:
    """Mentions of the previous day and of the previous ``days`` days, per book and day.

    ``daily`` has one row per (isbn13, mention_date). It is moved by book once; there each row is handed on to the
    days that look back on it, so the copies are not moved and no window needs the whole history of a book.
    """
    ahead = F.explode(F.sequence(F.lit(1), F.lit(days)))
    return (
        daily.select("isbn13", "mention_date", "mentions")
        .repartition("isbn13")
        .select("*", ahead.alias("ahead"))
        .groupBy("isbn13", F.date_add("mention_date", F.col("ahead")).alias("feature_date"))
        .agg(
            F.sum(F.when(F.col("ahead") == 1, F.col("mentions"))).alias("sns_mentions_1d"),
            F.sum("mentions").alias("sns_mentions_7d"),
        )
    )


def last_stockout(spine: DataFrame, inventory: DataFrame) -> DataFrame:
    """Adds ``days_since_last_stockout``: days since the last day with on_hand = 0.

    Both sides hold at most one row per (book, day), so a partition of the
    window is bounded by the length of the calendar.
    """
    out = (
        inventory.filter("on_hand = 0")
        .select("isbn13", F.col("snapshot_date").alias("feature_date"), F.col("snapshot_date").alias("_out"))
        .distinct()
    )
    both = spine.withColumn("_out", F.lit(None).cast("date")).withColumn("_keep", F.lit(True))
    both = both.unionByName(out.withColumn("_keep", F.lit(False)), allowMissingColumns=True)
    # Days with the same date see each other: a stockout today counts as 0 days.
    w = Window.partitionBy("isbn13").orderBy(F.datediff("feature_date", F.lit("1970-01-01").cast("date")))
    seen = F.max("_out").over(w.rangeBetween(Window.unboundedPreceding, 0))
    return (
        both.withColumn("days_since_last_stockout", F.datediff("feature_date", seen).cast("bigint"))
        .filter("_keep")
        .drop("_keep", "_out")
    )


def _facts(spine: DataFrame, mentions: DataFrame, inventory: DataFrame) -> DataFrame:
    """Mentions, stock and days since a stockout for every (isbn13, feature_date) of ``spine``.

    Spine, stock and mentions are stacked and moved by book once; range windows over the day number then look at the
    same day, the days before, and all days so far. A book has at most three rows a day, so a partition of the window
    is bounded by the calendar.
    """
    free = F.greatest(F.col("on_hand") - F.col("reserved_qty"), F.lit(0))
    stock = inventory.groupBy("isbn13", F.col("snapshot_date").alias("feature_date")).agg(
        F.sum(free).alias("_total"), F.max(F.when(F.col("on_hand") == 0, F.col("snapshot_date"))).alias("_out")
    )
    said = mentions.groupBy("isbn13", F.col("mention_date").alias("feature_date")).agg(F.sum("mentions").alias("_said"))
    stacked = spine.select("isbn13", "feature_date", F.lit(True).alias("_keep"))
    for part in (stock, said):
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    by_day = Window.partitionBy("isbn13").orderBy(F.datediff("feature_date", F.lit("1970-01-01").cast("date")))
    seen = F.max("_out").over(by_day.rangeBetween(Window.unboundedPreceding, 0))
    return stacked.select(
        "isbn13", "feature_date", "_keep",
        F.sum("_said").over(by_day.rangeBetween(-1, -1)).alias("sns_mentions_1d"),
        F.sum("_said").over(by_day.rangeBetween(-7, -1)).alias("sns_mentions_7d"),
        F.sum("_total").over(by_day.rangeBetween(0, 0)).alias("on_hand_total"),
        F.datediff("feature_date", seen).cast("bigint").alias("days_since_last_stockout"),
    ).filter("_keep")


def _stretched_facts(books: DataFrame, lo: Column, hi: Column, mentions: DataFrame, inventory: DataFrame) -> DataFrame:
    """What ``_facts`` gives for every row of ``books`` on every day from ``lo`` to ``hi``, beside the columns of the book.

    All of it are steps of the sparse rows: a mention enters its sums on the next day and leaves them one and seven days
    later, a stockout holds from its day on, stock counts on its own day. The steps are added up and stretched to the
    day before the next one, so only sparse rows are moved and sorted. Rows before ``lo`` count as they do for a window.
    """
    free = F.greatest(F.col("on_hand") - F.col("reserved_qty"), F.lit(0))
    day, said, none = F.col("mention_date"), F.coalesce("mentions", F.lit(0)), F.lit(0)

    def move(after: int, one: Column, week: Column) -> Column:
        return F.struct(F.date_add(day, after).alias("_at"), one.alias("_one"), week.alias("_week"))

    # A book that is listed more than once, or without a key, has its rows as often as before.
    seeds = books.groupBy("isbn13").agg(F.count("*").alias("_copies")).withColumn("_at", lo)
    stock = inventory.select(
        "isbn13", F.col("snapshot_date").alias("_at"), free.alias("_total"), F.when(F.col("on_hand") == 0, F.col("snapshot_date")).alias("_out")
    )
    moves = F.explode(F.array(move(1, said, said), move(2, -said, none), move(8, none, -said)))
    stacked = seeds.unionByName(stock, allowMissingColumns=True).unionByName(mentions.select("isbn13", moves.alias("_m")).select("isbn13", "_m.*"), allowMissingColumns=True)
    # The number is given so that small sparse partitions are not merged before they grow dense.
    parts = int(books.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    daily = (
        stacked.filter(F.col("_at") <= hi)
        .repartition(parts, "isbn13")
        .groupBy("isbn13", "_at")
        .agg(F.max("_copies").alias("_copies"), F.max("_out").alias("_out"), *[F.sum(c).alias(c) for c in ("_total", "_one", "_week")])
    )
    book = Window.partitionBy("isbn13")
    by_day = book.orderBy("_at")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    spread = daily.select(
        "isbn13", "_at", "_total",
        F.max("_copies").over(book).alias("_copies"), F.max("_out").over(so_far).alias("_out"),
        F.sum("_one").over(so_far).alias("sns_mentions_1d"), F.sum("_week").over(so_far).alias("sns_mentions_7d"),
        F.greatest("_at", lo).alias("_from"), F.coalesce(F.date_sub(F.lead("_at").over(by_day), 1), hi).alias("_to"),
    ).filter("_copies > 0 AND _from <= _to")
    times = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    listed = spread.withColumn("_copy", times).join(books.select("isbn13", "pub_date", "is_bestseller_flag"), "isbn13", "left")
    return listed.withColumn("feature_date", F.explode(F.sequence("_from", "_to"))).select(
        "feature_date", "isbn13", "pub_date", "is_bestseller_flag", "sns_mentions_1d", "sns_mentions_7d",
        F.when(F.col("feature_date") == F.col("_at"), F.col("_total")).alias("on_hand_total"),
        F.datediff("feature_date", "_out").cast("bigint").alias("days_since_last_stockout"),
    )


def build_daily_features(
    books: DataFrame, lo: Column, hi: Column, calendar: DataFrame, mentions: DataFrame, inventory: DataFrame
) -> DataFrame:
    """``build_features`` for every book on every day from ``lo`` to ``hi``; the dense rows are neither moved nor sorted."""
    facts = _stretched_facts(books, lo, hi, mentions, inventory)
    return _covariates(facts, F.broadcast(calendar))  # a row a day


def build_features(
    spine: DataFrame, calendar: DataFrame, books: DataFrame, mentions: DataFrame, inventory: DataFrame
) -> DataFrame:
    """Covariates for every (isbn13, feature_date) of ``spine``."""
    facts = _facts(spine, mentions, inventory).join(books.select("isbn13", "pub_date", "is_bestseller_flag"), "isbn13", "left")
    return _covariates(facts, calendar)


def _covariates(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    age = F.greatest(F.datediff("feature_date", "pub_date"), F.lit(0)).cast("bigint")
    return facts.join(calendar.withColumnRenamed("day", "feature_date"), "feature_date").select(
        "feature_date", "isbn13", "is_holiday", "holiday_name", "season", "day_of_week", "is_weekend", "month",
        "event_nearby_days",
        F.coalesce("sns_mentions_1d", F.lit(0)).alias("sns_mentions_1d"),
        F.coalesce("sns_mentions_7d", F.lit(0)).alias("sns_mentions_7d"),
        F.when(F.col("pub_date").isNull(), 0).otherwise(age).alias("book_age_days"),
        "is_bestseller_flag",
        F.coalesce("on_hand_total", F.lit(0)).alias("on_hand_total"),
        "days_since_last_stockout",
    )
