"""Training tables: sales, stock and covariates on a dense daily spine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import hash_bucket, weekday_of_date
from shelfcast.operators.keyed import dedupe_first
from shelfcast.operators.series import (
    densify,
    densify_with_history,
    densify_with_windows,
    mean_before,
    segment_of,
    with_lags,
    with_rolling_means,
)


def resolve_warehouse(sales: DataFrame, store_map: DataFrame, locations: DataFrame) -> DataFrame:
    """Warehouse of the store's location, else the one on the sales row."""
    home = store_map.select("store_id", "location_id").join(
        locations.select("location_id", F.col("wh_id").alias("_home")), "location_id"
    )
    return (
        sales.join(home.select("store_id", "_home"), "store_id", "left")
        .withColumn("wh_id", F.coalesce(F.col("_home").cast("bigint"), F.col("wh_id")))
        .drop("_home")
    )


def daily_warehouse_sales(sales: DataFrame, store_map: DataFrame, locations: DataFrame) -> DataFrame:
    placed = resolve_warehouse(sales, store_map, locations).filter(
        F.col("sale_date").isNotNull() & F.col("wh_id").isNotNull()
    )
    return placed.groupBy(F.col("sale_date").alias("feature_date"), "isbn13", "wh_id").agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("qty_sold", "revenue", "tx_count")]
    )


def daily_warehouse_inventory(inventory: DataFrame, locations: DataFrame) -> DataFrame:
    return (
        inventory.filter(F.col("snapshot_date").isNotNull())
        .join(locations.select("location_id", F.col("wh_id").cast("bigint").alias("wh_id")), "location_id")
        .groupBy(F.col("snapshot_date").alias("feature_date"), "isbn13", "wh_id")
        .agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("on_hand", "reserved_qty")])
    )


def _one_table(parts: list[DataFrame], keys: list[str], sums: list[str]) -> DataFrame:
    """Stack per-day facts of different kinds and add them up in one aggregation.

    This replaces a chain of joins on the same keys by a single shuffle.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])


def _period(sales: DataFrame, period: tuple | None):
    """First and last day: as given, else looked up in the sales."""
    if period is not None:
        return period
    bounds = sales.agg(F.min("sale_date").alias("lo"), F.max("sale_date").alias("hi"))
    return bounds.select("lo").scalar(), bounds.select("hi").scalar()


def _warehouse_facts(
    sales: DataFrame, inventory: DataFrame, store_map: DataFrame, locations: DataFrame, measures, lo: Column, hi: Column
) -> tuple[DataFrame, list[str]]:
    """Sparse rows by (isbn13, wh_id, day) with ``_series`` set for every series that ever sold, and the summed columns."""
    keys = ["isbn13", "wh_id"]
    sums = [*measures, "on_hand", "reserved_qty"]
    inside = F.col("feature_date").between(lo, hi)
    placed = resolve_warehouse(sales, store_map, locations).filter(F.col("sale_date").isNotNull() & F.col("wh_id").isNotNull())
    series = placed.select(*keys).distinct().select(*keys, lo.alias("feature_date"), F.lit(1).alias("_series"))
    sold = daily_warehouse_sales(sales, store_map, locations).filter(inside).select(*keys, "feature_date", *measures)
    stock = daily_warehouse_inventory(inventory, locations).filter(inside)
    return _one_table([series, sold, stock], [*keys, "feature_date"], [*sums, "_series"]), sums


def warehouse_panel(
    sales: DataFrame, inventory: DataFrame, store_map: DataFrame, locations: DataFrame, measures=("qty_sold",),
    period: tuple | None = None, windows: dict | None = None,
) -> DataFrame:
    """Dense (isbn13, wh_id, day) panel of sales and stock for every series that ever sold.

    With a shorter ``period`` only its days are read and built; the list of
    series still comes from all sales. ``windows`` are the lags, spans and lookback
    of ``densify_with_windows`` over the sold quantity, if the panel is to have them.
    """
    keys = ["isbn13", "wh_id"]
    lo, hi = _period(sales, period)
    daily, sums = _warehouse_facts(sales, inventory, store_map, locations, measures, lo, hi)
    listed = _listed(daily, keys, "_series")
    if windows is None:
        return densify(listed, keys, "feature_date", sums, lo, hi)
    dense = densify_with_windows(listed, keys, "feature_date", sums, lo, hi, "qty_sold", **windows)
    return dense.drop(*[c for c in dense.columns if c.startswith("_sum_")])


def _listed(daily: DataFrame, keys: list[str], mark: str) -> DataFrame:
    """Rows of the series that carry the mark on one of their days."""
    known = F.max(mark).over(Window.partitionBy(*keys)) > 0
    # The number is given so that small sparse partitions are not merged before they grow dense.
    parts = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return daily.repartition(parts, *keys).withColumn("_known", known).filter("_known").drop("_known", mark)


#: Covariates of a book on a day, as the feature table has them.
DAILY = (
    "is_holiday", "day_of_week", "month", "is_weekend", "event_nearby_days", "sns_mentions_1d", "sns_mentions_7d", "book_age_days",
    "days_since_last_stockout",
)


def _beside_facts(facts: DataFrame, features: DataFrame, keys: list[str], mark: str, names=DAILY) -> DataFrame:
    """Sparse rows of the marked series, with a row for each of their book's days that has covariates (columns ``_daily_..``).

    Facts and covariates are stacked and moved by book once. All that follows groups by the book and more, so the
    covariates need no join by day and dense rows are never moved. A book holds at most its days times its places.
    Covariates are plain columns, of which one row of a book and day has them, so unused ones are not moved and the
    largest value is the only one.
    """
    book, place = keys
    daily = [F.col(c).alias(f"_daily_{c}") for c in names]
    stacked = facts.unionByName(features.select(book, "feature_date", F.lit(1).alias("_covered"), *daily), allowMissingColumns=True)
    places = F.collect_set(F.when(F.col(mark) > 0, F.col(place))).over(Window.partitionBy(book))
    own = F.filter("_places", lambda p: p == F.col(place))  # empty if the series is not marked
    each = F.explode(F.when(F.col("_covered").isNotNull(), F.col("_places")).otherwise(own))
    # The number is given so that small sparse partitions are not merged before they grow dense.
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = stacked.repartition(parts, book).withColumn("_places", places).withColumn("_place", each).drop(place, "_places")
    values = [c for c in facts.columns if c not in (*keys, "feature_date", mark)]
    return (
        spread.withColumnRenamed("_place", place)
        .groupBy(*keys, "feature_date")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in values], *[F.max(c).alias(c) for c in _daily(names)])
    )


def _daily(names=DAILY) -> list[str]:
    """The columns that carry covariates beside the facts."""
    return [f"_daily_{c}" for c in names]


def dense_with_covariates(
    facts: DataFrame, features: DataFrame, keys: list[str], mark: str, lo: Column, hi: Column, names=DAILY, books: DataFrame | None = None,
    hold: Callable | None = None,
) -> DataFrame:
    """The marked series of ``facts`` on every day from ``lo`` to ``hi``, with the covariates of the book and day or NULL.

    ``features`` has at most one row per book and day. The result is partitioned by book. ``books`` adds the attributes
    of ``with_book``, ``hold`` what follows from the carried covariates instead of the plain ones.
    """
    beside = _beside_facts(facts, features, keys, mark, names)
    carried = _daily(names)
    values = [c for c in beside.columns if c not in (*keys, "feature_date", *carried)]
    plain = lambda rows: rows.select("*", *[F.col(f"_daily_{c}").alias(c) for c in names])
    dense = densify(beside, keys, "feature_date", values, lo, hi, sparse=carried, extend=_book_columns(books), hold=hold or plain)
    return dense.select("feature_date", *[c for c in dense.columns if c not in ("feature_date", *carried)])


def _held_covariates(rows: DataFrame) -> DataFrame:
    """Carried covariates that need no date: what is missing becomes zero. Parts of the date stay as they are."""

    def zero(c):
        return F.coalesce(f"_daily_{c}", F.lit(0)).alias(c)

    return rows.select(
        "*",
        F.coalesce("_daily_is_holiday", F.lit(False)).cast("int").alias("holiday_flag"),
        *[zero(c) for c in ("event_nearby_days", "sns_mentions_1d", "sns_mentions_7d", "book_age_days", "days_since_last_stockout")],
        *[F.col(f"_daily_{c}").alias(f"_{c}") for c in ("day_of_week", "month", "is_weekend")],
    )


def _covariates() -> list[Column]:
    """Covariates of a dense row of ``_held_covariates``: missing parts of the date are derived from it."""
    day = F.col("feature_date")
    return [
        F.col("holiday_flag"),
        F.coalesce("_day_of_week", weekday_of_date(day)).alias("day_of_week"),
        F.coalesce("_month", F.month(day).cast("bigint")).alias("month"),
        F.coalesce("_is_weekend", weekday_of_date(day).isin(1, 7)).cast("int").alias("weekend_flag"),
        *[F.col(c) for c in ("event_nearby_days", "sns_mentions_1d", "sns_mentions_7d", "book_age_days", "days_since_last_stockout")],
    ]


#: Columns that ``with_book`` adds.
BOOK = ["category_id", "price_tier", "sales_point", "bestseller_flag", "author_experience_years"]


def with_book(dense: DataFrame, books: DataFrame) -> DataFrame:
    """Add the attributes of the book. A side that is partitioned by book stays where it is.

    A join of tables too large to broadcast sorts both; series are joined while they are sparse (``extend``).
    """
    book = books.select(
        "isbn13", "category_id", "price_tier", F.coalesce("sales_point", F.lit(0)).alias("sales_point"),
        F.coalesce("is_bestseller_flag", F.lit(False)).cast("int").alias("bestseller_flag"),
        F.coalesce("author_experience_years", F.lit(0)).alias("author_experience_years"),
    )
    return dense.join(book, "isbn13", "left").fillna(0, ["sales_point", "bestseller_flag", "author_experience_years"])


def _book_columns(books: DataFrame | None):
    return None if books is None else lambda rows: with_book(rows, books)


def enriched_warehouse_panel(
    sales: DataFrame, inventory: DataFrame, features: DataFrame, store_map: DataFrame, locations: DataFrame,
    period: tuple | None = None, books: DataFrame | None = None,
) -> DataFrame:
    """The warehouse panel with covariates and, given ``books``, their attributes; ``features`` may hold copies."""
    keys = ["isbn13", "wh_id"]
    lo, hi = _period(sales, period)
    daily, sums = _warehouse_facts(sales, inventory, store_map, locations, ("qty_sold",), lo, hi)
    dense = dense_with_covariates(daily, dedupe_features(features, period), keys, "_series", lo, hi, books=books, hold=_held_covariates)
    book = BOOK if books is not None else []
    return dense.select("feature_date", *keys, *sums, *_covariates(), *book)


def dedupe_features(features: DataFrame, period: tuple | None = None) -> DataFrame:
    """One covariate row per book and day; copies are resolved by column order."""
    rows = features if period is None else features.filter(F.col("feature_date").between(*period))
    return dedupe_first(rows, ["isbn13", "feature_date"])


def training_dataset_wh(
    sales: DataFrame, inventory: DataFrame, features: DataFrame, books: DataFrame, store_map: DataFrame,
    locations: DataFrame, drop_prelaunch: bool = True, period: tuple | None = None,
) -> DataFrame:
    """The enriched panel with lags and means; rows of a negative ``book_age_days`` leave first if ``drop_prelaunch``.

    Lags and means are steps of the sparse rows. Only books with a negative age lose days, so only theirs are windows over
    the dense rows that are left.
    """
    keys = ["isbn13", "wh_id"]
    lo, hi = _period(sales, period)
    daily, sums = _warehouse_facts(sales, inventory, store_map, locations, ("qty_sold",), lo, hi)
    beside = _beside_facts(daily, dedupe_features(features, period), keys, "_series")

    def stepped(rows: DataFrame) -> DataFrame:
        dense = densify_with_history(rows, keys, "feature_date", sums, lo, hi, "qty_sold", sparse=_daily(), extend=_book_columns(books), hold=_held_covariates)
        lags = [F.col(f"_lag_{k}").alias(f"qty_lag_{k}") for k in (1, 7)]
        means = [mean_before(n).alias(f"qty_rolling_{n}d") for n in (7, 28)]
        return dense.select("feature_date", *keys, *sums, *_covariates(), *lags, *means, *BOOK)

    def windowed(rows: DataFrame) -> DataFrame:
        dense = densify(rows, keys, "feature_date", sums, lo, hi, sparse=_daily(), hold=_held_covariates)
        kept = dense.select("feature_date", *keys, *sums, *_covariates()).filter("book_age_days >= 0")
        return with_book(with_rolling_means(with_lags(kept, keys, "feature_date", "qty_sold"), keys, "feature_date", "qty_sold"), books)

    # Asked first, since without such books the other way would read and sort all sparse rows for nothing.
    if not drop_prelaunch or features.filter("book_age_days < 0").isEmpty():
        return stepped(beside)
    early = F.coalesce(F.min("_daily_book_age_days").over(Window.partitionBy("isbn13")) < 0, F.lit(False))
    marked = beside.withColumn("_early", early)
    return stepped(marked.filter("NOT _early")).unionByName(windowed(marked.filter("_early")))


def store_attributes(locations: DataFrame) -> DataFrame:
    online = F.col("location_type") == "STORE_ONLINE"
    return locations.filter(F.col("location_type") != "WH").select(
        F.col("location_id").cast("bigint").alias("store_id"),
        F.col("wh_id").cast("bigint").alias("wh_id"),
        F.when(online, "online").otherwise("offline").alias("channel"),
        F.when(online, "STORE_ONLINE").otherwise("STORE_OFFLINE").alias("location_type"),
        F.coalesce("size", F.lit("L")).alias("store_size"),
        "region",
    )


STORE_SUMS = ["qty_sold", "on_hand", "reserved_qty", "safety_stock"]


def _store_facts(
    sales: DataFrame, inventory: DataFrame, books: DataFrame, store_map: DataFrame, stores: DataFrame, stock_via: str, lo: Column, hi: Column
) -> DataFrame:
    """Sparse rows by (isbn13, store_id, day), ``_book`` set for every book and store."""
    keys, sums = ["isbn13", "store_id"], STORE_SUMS
    sold = sales.filter(F.col("sale_date").between(lo, hi)).join(stores, "store_id", "left_semi").select(
        *keys, F.col("sale_date").alias("feature_date"), F.coalesce("qty_sold", F.lit(0)).alias("qty_sold")
    )
    link = store_map.select("store_id", F.col("inventory_location_id" if stock_via == "inventory_location" else "location_id").alias("location_id"))
    # Stock columns are taken as they are, so a second row for one key is an error, not a second helping.
    stock = (
        inventory.filter(F.col("snapshot_date").between(lo, hi))
        .groupBy("snapshot_date", "isbn13", "location_id")
        .agg(F.count("*").alias("_n"), *[F.max(c).alias(c) for c in sums[1:]])
        .withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.lit("inventory has two rows for one book, place and day"))).otherwise(F.lit(0)))
        .join(link, "location_id")
        .filter("_n = 0")
        .join(stores, "store_id", "left_semi")
        .select("isbn13", F.col("store_id").cast("bigint").alias("store_id"), F.col("snapshot_date").alias("feature_date"), *sums[1:])
    )
    # Every book starts with a zero row in every store, so pairs without sales get a series too.
    all_stores = stores.agg(F.sort_array(F.collect_set(F.col("store_id").cast("bigint"))).alias("s")).scalar()
    seeds = books.select("isbn13", F.explode(all_stores).alias("store_id"), lo.alias("feature_date"), F.lit(1).alias("_book"))
    return _one_table([sold, stock, seeds], [*keys, "feature_date"], [*sums, "_book"])


def store_panel(
    sales: DataFrame, inventory: DataFrame, books: DataFrame, store_map: DataFrame, stores: DataFrame,
    stock_via: str = "store", period: tuple | None = None,
) -> DataFrame:
    """Dense (isbn13, store_id, day) panel over every book and every store of ``stores`` (column store_id).

    ``stock_via="store"`` reads stock at the store's own id, so online stores
    have none; ``"inventory_location"`` reads it where the store draws from.
    """
    keys = ["isbn13", "store_id"]
    lo, hi = _period(sales, period)
    daily = _store_facts(sales, inventory, books, store_map, stores, stock_via, lo, hi)
    return densify(_listed(daily, keys, "_book"), keys, "feature_date", STORE_SUMS, lo, hi)


def training_dataset_store(
    sales: DataFrame, inventory: DataFrame, features: DataFrame, books: DataFrame, store_map: DataFrame,
    locations: DataFrame, stock_via: str = "store", period: tuple | None = None, since: Column | None = None,
) -> DataFrame:
    """Every book and store on every day. Days of the period before ``since`` are lead-in of the windows and get no rows."""
    keys = ["isbn13", "store_id"]
    stores = store_attributes(locations)
    lo, hi = _period(sales, period)
    daily = _store_facts(sales, inventory, books, store_map, stores.select("store_id"), stock_via, lo, hi)
    beside = _beside_facts(daily, dedupe_features(features, period if since is None else (since, hi)), keys, "_book")
    # Attributes of books and stores are joined while the rows are sparse.
    places = [c for c in stores.columns if c != "store_id"]
    dense = densify_with_history(
        beside, keys, "feature_date", STORE_SUMS, lo, hi, "qty_sold", sparse=_daily(), since=since,
        extend=lambda rows: with_book(rows, books).join(F.broadcast(stores), "store_id"),  # a row a store of the inline table
        hold=lambda rows: _held_covariates(rows).withColumn("demand_segment", segment_of(F.col("_sum_28"))),
    )
    return dense.select(
        "store_id", "feature_date", "isbn13", *STORE_SUMS, *_covariates(),
        *[F.col(f"_lag_{k}").alias(f"qty_lag_{k}") for k in (1, 7)],
        *[mean_before(n).alias(f"qty_rolling_{n}d") for n in (7, 28)],
        "demand_segment", *BOOK, *places,
    )


def store_demand_classes(
    sales: DataFrame, inventory: DataFrame, books: DataFrame, store_map: DataFrame, stores: DataFrame,
    stock_via: str = "store", period: tuple | None = None, windows: dict | None = None,
) -> DataFrame:
    """The dense store panel with the demand class of each day, from the 28 days before it.

    ``windows`` are lags, spans and lookback of ``densify_with_windows``; 28 is among the spans.
    """
    keys = ["isbn13", "store_id"]
    lo, hi = _period(sales, period)
    daily = _listed(_store_facts(sales, inventory, books, store_map, stores, stock_via, lo, hi), keys, "_book")
    if windows is None:
        dense = densify_with_history(daily, keys, "feature_date", STORE_SUMS, lo, hi, "qty_sold", lags=(), spans=(28,))
        return dense.select(*keys, "feature_date", *STORE_SUMS, segment_of(F.col("_sum_28")).alias("demand_segment"))
    dense = densify_with_windows(daily, keys, "feature_date", STORE_SUMS, lo, hi, "qty_sold", **windows)
    dense = dense.withColumn("demand_segment", segment_of(F.col("_sum_28")))
    return dense.drop(*[c for c in dense.columns if c.startswith("_sum_")])


def automl_input(
    sales: DataFrame, features: DataFrame, books: DataFrame, store_map: DataFrame, locations: DataFrame,
    period: tuple | None = None,
) -> DataFrame:
    """Wide table with one ``series_id`` per book and warehouse."""
    keys = ["isbn13", "wh_id"]
    lo, hi = _period(sales, period)
    placed = resolve_warehouse(sales, store_map, locations).filter(F.col("wh_id").isNotNull() & F.col("sale_date").between(lo, hi))
    daily = placed.groupBy(*keys, F.col("sale_date").alias("feature_date")).agg(
        F.sum("qty_sold").alias("qty_sold"),
        F.sum("revenue").alias("revenue"),
        F.avg(F.coalesce("avg_price", F.lit(0)).cast("double")).alias("avg_price"),
        F.sum("tx_count").alias("tx_count"),
        F.lit(1).alias("_series"),
    )
    names = ["sns_mentions_1d", "sns_mentions_7d", "is_holiday", "event_nearby_days", "season", "day_of_week", "month", "is_weekend"]
    dense = dense_with_covariates(daily, dedupe_features(features, period), keys, "_series", lo, hi, names, books)
    return dense.select(
        F.concat("isbn13", F.lit("_WH"), F.col("wh_id").cast("string")).alias("series_id"),
        F.col("feature_date").alias("sale_date"), "qty_sold", "revenue", "avg_price", "tx_count",
        F.coalesce("sns_mentions_1d", F.lit(0)).alias("sns_mentions_1d"),
        F.coalesce("sns_mentions_7d", F.lit(0)).alias("sns_mentions_7d"),
        F.coalesce("is_holiday", F.lit(False)).alias("is_holiday"),
        F.coalesce("event_nearby_days", F.lit(0)).alias("event_nearby_days"),
        "season", "day_of_week", "month", F.coalesce("is_weekend", F.lit(False)).alias("is_weekend"), "wh_id",
        "category_id", "price_tier", F.col("bestseller_flag").alias("is_bestseller_flag"), "author_experience_years",
    )


# Role of each column of ``automl_input`` for a forecasting service.
AUTOML_COLUMN_ROLES = {
    "static": ["wh_id", "category_id", "price_tier", "is_bestseller_flag", "author_experience_years"],
    "known_ahead": ["is_holiday", "event_nearby_days", "season", "day_of_week", "month", "is_weekend"],
    "past_only": ["revenue", "avg_price", "tx_count", "sns_mentions_1d", "sns_mentions_7d"],
}


def holdout_split(
    training: DataFrame, window_days: int = 134, holdout_days: int = 14, train_percent: int = 25,
    segments=("high", "medium"), keys=("isbn13", "store_id"), newest: Column | None = None,
) -> DataFrame:
    """Whole holdout plus a stable hash sample of the days before it."""
    if newest is None:
        newest = training.agg(F.max("feature_date").alias("d")).scalar()
    key = F.concat_ws("#", *[F.col(k).cast("string") for k in keys], F.col("feature_date").cast("string"))
    held = F.col("feature_date") > F.date_sub(newest, holdout_days)
    return (
        training.filter(F.col("feature_date") > F.date_sub(newest, window_days))
        .filter(F.col("demand_segment").isin(*segments) & F.col("qty_sold").isNotNull())
        .withColumn("split_name", F.when(held, "holdout").otherwise("train"))
        .filter(held | (hash_bucket(key) < train_percent))
    )
