"""Windows, ordering, top-k (W1 to W14), training tables (F0 to F4) and table metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import fixtures as fx
from shelfcast.catalog.join_queries import COVARIATE_INTS, COVARIATE_SQL, DAY_PARTS, ENRICHED_SQL, PANEL_INTS, PANEL_SQL, wh_panel
from shelfcast.catalog.reference_sql import ISBN, TABLES
from shelfcast.catalog.registry import query
from shelfcast.catalog.util import digest, digest_sql, rounded
from shelfcast.domain import HOLIDAYS, locations_static, store_location_map
from shelfcast.functions.columns import safe_ratio
from shelfcast.operators import calendar as cal
from shelfcast.operators import features as feat
from shelfcast.operators import rollups, series
from shelfcast.operators.keyed import latest_per_key
from shelfcast.plans import gates, policy, training
from shelfcast.session import fresh_dir, through_disk
from shelfcast.sources.tables import read_current

WH = ["isbn13", "wh_id"]
STORE = ["isbn13", "store_id"]

TABLES["panel_wh"] = PANEL_SQL
TABLES["train_wh"] = f"""
SELECT *, lag(qty_sold, 1) OVER w AS qty_lag_1, lag(qty_sold, 7) OVER w AS qty_lag_7,
       avg(qty_sold) OVER (PARTITION BY isbn13, wh_id ORDER BY feature_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS qty_rolling_7d,
       avg(qty_sold) OVER (PARTITION BY isbn13, wh_id ORDER BY feature_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS qty_rolling_28d
FROM ({ENRICHED_SQL}) WHERE book_age_days >= 0 WINDOW w AS (PARTITION BY isbn13, wh_id ORDER BY feature_date)
"""
#: Days of the store table that the split and the models read: their window, and the lead-in of the rolling means.
STORE_DAYS = 134 + 28
TABLES["store_days"] = f"SELECT day FROM sales_days WHERE day > (SELECT max(day) FROM sales_days) - {STORE_DAYS}"


def panel_store_sql(days: str) -> str:
    return f"""
SELECT d.day AS feature_date, b.isbn13, CAST(l.location_id AS BIGINT) AS store_id, coalesce(s.q, 0) AS qty_sold, coalesce(i.on_hand, 0) AS on_hand,
       coalesce(i.reserved_qty, 0) AS reserved_qty, coalesce(i.safety_stock, 0) AS safety_stock
FROM {days} d CROSS JOIN books_static b CROSS JOIN (SELECT location_id FROM locations_static WHERE location_type <> 'WH') l
LEFT JOIN (SELECT sale_date, isbn13, store_id, CAST(sum(qty_sold) AS BIGINT) AS q FROM sales_fact GROUP BY 1, 2, 3) s
  ON s.sale_date = d.day AND s.isbn13 = b.isbn13 AND s.store_id = l.location_id
LEFT JOIN inventory_daily i ON i.snapshot_date = d.day AND i.isbn13 = b.isbn13 AND i.location_id = l.location_id
"""


def train_store_sql(panel: str) -> str:
    return f"""
SELECT x.*, CAST(l.wh_id AS BIGINT) AS wh_id, CASE WHEN l.location_type = 'STORE_ONLINE' THEN 'online' ELSE 'offline' END AS channel,
       l.location_type, l.size AS store_size, l.region,
       lag(qty_sold, 1) OVER w AS qty_lag_1, lag(qty_sold, 7) OVER w AS qty_lag_7,
       avg(qty_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS qty_rolling_7d,
       avg(qty_sold) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS qty_rolling_28d,
       CASE WHEN sum(qty_sold) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) >= 12 THEN 'high'
            WHEN sum(qty_sold) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) >= 3 THEN 'medium' ELSE 'low' END AS demand_segment
FROM (SELECT p.*, {COVARIATE_SQL} FROM {panel} p
      LEFT JOIN features f ON f.isbn13 = p.isbn13 AND f.feature_date = p.feature_date LEFT JOIN books_static b ON b.isbn13 = p.isbn13) x
JOIN locations_static l ON l.location_id = x.store_id
WINDOW w AS (PARTITION BY isbn13, store_id ORDER BY feature_date)
"""


# The whole period, and the last days for what reads no more of it
TABLES["panel_store_all"], TABLES["panel_store"] = panel_store_sql("sales_days"), panel_store_sql("store_days")
TABLES["train_store_all"], TABLES["train_store"] = train_store_sql("panel_store_all"), train_store_sql("panel_store")
MEANS = ["qty_rolling_7d", "qty_rolling_28d"]
LAGS = ["qty_lag_1", "qty_lag_7"]
WH_DAYS = dict(keys=WH, day="feature_date")
TRAIN_WH = dict(**WH_DAYS, ints=PANEL_INTS + COVARIATE_INTS + LAGS, floats=MEANS, texts=["price_tier"])
TRAIN_STORE = dict(
    keys=STORE, day="feature_date", ints=[*PANEL_INTS, "safety_stock", *COVARIATE_INTS, "wh_id", *LAGS], floats=MEANS,
    texts=["price_tier", "channel", "location_type", "store_size", "region", "demand_segment"],
)


def train_wh(spark, sf):
    return training.training_dataset_wh(
        fx.sales_fact(spark, sf), fx.inventory_daily(spark, sf), fx.features(spark, sf), fx.books_static(spark, sf),
        store_location_map(spark), locations_static(spark), period=fx.sale_period(spark, sf),
    )


def train_store(spark, sf, last=None, shown=None):
    """The store table of the last days, of which the newest ``shown`` get rows; the others are lead-in."""
    since = None if shown is None else F.date_sub(fx.newest_sale(spark, sf), shown - 1)
    return training.training_dataset_store(
        fx.sales_fact(spark, sf), fx.inventory_daily(spark, sf), fx.features(spark, sf), fx.books_static(spark, sf),
        store_location_map(spark), locations_static(spark), period=fx.sale_period(spark, sf, last), since=since,
    )


def store_panel(spark, sf, last=None, windows=None):
    """The dense store panel with its demand class, without covariates."""
    return training.store_demand_classes(
        fx.sales_fact(spark, sf), fx.inventory_daily(spark, sf), fx.books_static(spark, sf), store_location_map(spark), store_location_map(spark).select("store_id"),
        period=fx.sale_period(spark, sf, last), windows=windows,
    )


SEGMENT_TABLE = """
SELECT *, CASE WHEN sum(qty_sold) OVER w >= 12 THEN 'high' WHEN sum(qty_sold) OVER w >= 3 THEN 'medium' ELSE 'low' END AS demand_segment
FROM {} WINDOW w AS (PARTITION BY isbn13, store_id ORDER BY feature_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
"""
TABLES["panel_segment_all"], TABLES["panel_segment"] = SEGMENT_TABLE.format("panel_store_all"), SEGMENT_TABLE.format("panel_store")


@query(
    "lag_features",
    digest_sql(
        """SELECT feature_date, isbn13, wh_id, qty_sold, lag(qty_sold, 1) OVER w AS qty_lag_1, lag(qty_sold, 7) OVER w AS qty_lag_7
           FROM panel_wh WINDOW w AS (PARTITION BY isbn13, wh_id ORDER BY feature_date)""",
        **WH_DAYS, ints=["qty_sold", *LAGS],
    ),
)
def lag_features(spark, sf):
    panel = wh_panel(spark, sf, windows=dict(lags=(1, 7))).select("feature_date", *WH, "qty_sold", *LAGS)
    return digest(panel, **WH_DAYS, ints=["qty_sold", *LAGS])


@query(
    "rolling_mean",
    digest_sql(
        """SELECT feature_date, isbn13, wh_id, qty_sold,
                  avg(qty_sold) OVER (PARTITION BY isbn13, wh_id ORDER BY feature_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS qty_rolling_7d,
                  avg(qty_sold) OVER (PARTITION BY isbn13, wh_id ORDER BY feature_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS qty_rolling_28d
           FROM panel_wh""",
        **WH_DAYS, ints=["qty_sold"], floats=MEANS,
    ),
)
def rolling_mean(spark, sf):
    panel = wh_panel(spark, sf, windows=dict(spans=(7, 28))).select("feature_date", *WH, "qty_sold", *MEANS)
    return digest(panel, **WH_DAYS, ints=["qty_sold"], floats=MEANS)


SEGMENT_DAYS = dict(keys=[*STORE, "demand_segment"], day="feature_date", ints=["qty_sold"])


@query("rolling_sum_segment", digest_sql("panel_segment_all", **SEGMENT_DAYS))
def rolling_sum_segment(spark, sf):
    return digest(store_panel(spark, sf), **SEGMENT_DAYS)


@query(
    "intermittent_stats",
    digest_sql(
        """SELECT feature_date, isbn13, wh_id, avg(CASE WHEN qty_sold > 0 THEN qty_sold END) OVER w AS nonzero_mean_qty,
                  avg(CASE WHEN qty_sold > 0 THEN 1.0 ELSE 0.0 END) OVER w AS nonzero_probability
           FROM panel_wh WINDOW w AS (PARTITION BY isbn13, wh_id ORDER BY feature_date ROWS BETWEEN 56 PRECEDING AND 1 PRECEDING)""",
        **WH_DAYS, floats=["nonzero_mean_qty", "nonzero_probability"],
    ),
)
def intermittent_stats(spark, sf):
    panel = wh_panel(spark, sf, windows=dict(lookback=56)).select("feature_date", *WH, "nonzero_mean_qty", "nonzero_probability")
    return digest(panel, **WH_DAYS, floats=["nonzero_mean_qty", "nonzero_probability"])


@query(
    "dedup_first",
    "SELECT isbn13, feature_date, is_holiday, season, sns_mentions_7d, book_age_days, on_hand_total FROM features",
)
def dedup_first(spark, sf):
    rows = fx.features(spark, sf).select("isbn13", "feature_date", "is_holiday", "season", "sns_mentions_7d", "book_age_days", "on_hand_total")
    copies = rows.withColumn("on_hand_total", F.col("on_hand_total") + 1)
    return training.dedupe_features(rows.unionByName(copies))


@query(
    "latest_features",
    """SELECT isbn13, store_id, sale_date, qty_sold, revenue FROM (
         SELECT *, row_number() OVER (PARTITION BY isbn13, store_id ORDER BY sale_date DESC, qty_sold DESC, revenue DESC) AS rn FROM sales_fact) WHERE rn = 1""",
)
def latest_features(spark, sf):
    rows = fx.sales_fact(spark, sf).select("isbn13", "store_id", "sale_date", "qty_sold", "revenue")
    return latest_per_key(rows, STORE, ["sale_date"])


@query(
    "top_isbn",
    """SELECT sale_date, store_id, isbn13 AS top_isbn, q AS top_qty FROM (
         SELECT sale_date, store_id, isbn13, CAST(sum(qty) AS BIGINT) AS q, row_number() OVER (PARTITION BY sale_date, store_id ORDER BY sum(qty) DESC, isbn13) AS rn
         FROM sales_lines GROUP BY 1, 2, 3) WHERE rn = 1""",
)
def top_isbn(spark, sf):
    return rollups.top_book(fx.sales_lines(spark, sf), ["sale_date", "store_id"])


@query(
    "stores_per_wh",
    """SELECT s.store_id, CAST(l.wh_id AS BIGINT) AS wh_id, c.n AS store_count, CAST(sum(s.qty) AS BIGINT) AS qty FROM sales_lines s
       JOIN locations_static l ON l.location_id = s.store_id JOIN (SELECT wh_id, count(*) AS n FROM locations_static WHERE location_type LIKE 'STORE%' GROUP BY 1) c
       ON c.wh_id = l.wh_id GROUP BY 1, 2, 3""",
)
def stores_per_wh(spark, sf):
    sold = fx.sales_lines(spark, sf).groupBy("store_id").agg(F.sum("qty").alias("qty"))
    return policy.stores_per_warehouse(store_location_map(spark), locations_static(spark)).join(sold, "store_id")


@query(
    "share_of_total",
    """SELECT isbn13, wh_id, store_id, round(CAST(q AS DOUBLE) / nullif(sum(q) OVER (PARTITION BY isbn13, wh_id), 0), 6) AS demand_share
       FROM (SELECT isbn13, wh_id, store_id, sum(qty) AS q FROM sales_lines GROUP BY 1, 2, 3)""",
)
def share_of_total(spark, sf):
    per_store = fx.sales_lines(spark, sf).groupBy(*WH, "store_id").agg(F.sum("qty").alias("q"))
    totals = per_store.groupBy(*WH).agg(F.sum("q").alias("t"))
    return rounded(per_store.join(totals, WH).select(*WH, "store_id", safe_ratio("q", "t").alias("demand_share")), 6)


@query(
    "spike_zscore_cross",
    f"""WITH c AS (SELECT {ISBN.format('user_id')} AS isbn13, count(*) AS count_w FROM events
                   WHERE event_type = 'purchase' AND ts > (SELECT max(ts) FROM events) - INTERVAL 5 DAY GROUP BY 1),
            s AS (SELECT avg(count_w) AS mean_w, stddev_pop(count_w) AS std_w FROM c)
        SELECT isbn13, count_w, round(mean_w, 4) AS mean_w, round(std_w, 4) AS std_w, round((count_w - mean_w) / std_w, 4) AS z_score
        FROM c, s WHERE std_w > 0 AND (count_w - mean_w) / std_w >= 1.5""",
)
def spike_zscore_cross(spark, sf):
    events = fx.table(spark, sf, "events")
    until = events.agg(F.max(F.col("ts").cast("timestamp")).alias("m")).scalar()
    sales = events.filter("event_type = 'purchase'").select(fx.isbn("user_id").alias("isbn13"), F.col("ts").cast("timestamp").alias("event_ts"))
    found = rollups.cross_spikes(sales, until - F.expr("INTERVAL 5 DAY"), until, threshold=1.5)
    return rounded(found).orderBy(F.desc("z_score"), "isbn13")


@query("days_since_stockout", "SELECT isbn13, feature_date, days_since_last_stockout FROM features")
def days_since_stockout(spark, sf):
    spine = fx.sales_lines(spark, sf).select("isbn13", F.col("sale_date").alias("feature_date")).distinct()
    return feat.last_stockout(spine, fx.inventory_daily(spark, sf))


@query("next_event_days", "SELECT c.day, c.event_nearby_days, count(s.txn_id) AS lines FROM calendar c LEFT JOIN sales_lines s ON s.sale_date = c.day GROUP BY 1, 2")
def next_event_days(spark, sf):
    bounds = fx.literal_bounds(spark, sf)
    near = cal.next_event_days(cal.day_range(bounds), cal.holiday_dates(spark, bounds, HOLIDAYS))
    lines = fx.sales_lines(spark, sf).groupBy(F.col("sale_date").alias("day")).agg(F.count("*").alias("lines"))
    return near.join(lines, "day", "left").select("day", "event_nearby_days", F.coalesce("lines", F.lit(0)).alias("lines"))


@query(
    "sns_trailing",
    """WITH p AS (SELECT DISTINCT isbn13, mention_date + k AS feature_date FROM sns_daily, (VALUES (1), (2), (3), (4), (5), (6), (7)) AS o(k))
       SELECT p.isbn13, p.feature_date, CAST(sum(n.mentions) FILTER (n.mention_date = p.feature_date - 1) AS BIGINT) AS sns_mentions_1d,
              CAST(sum(n.mentions) AS BIGINT) AS sns_mentions_7d
       FROM p JOIN sns_daily n ON n.isbn13 = p.isbn13 AND n.mention_date BETWEEN p.feature_date - 7 AND p.feature_date - 1 GROUP BY 1, 2""",
)
def sns_trailing(spark, sf):
    return feat.trailing_mentions(fx.sns_daily(spark, sf))


@query(
    "ordered_rank_rules",
    """SELECT publisher, store_id, round(CAST(sum(qty) AS DOUBLE) / count(*) / 25, 4) AS multiplier, count(*) AS train_rows
       FROM sales_lines s JOIN books_static b ON b.isbn13 = s.isbn13 GROUP BY 1, 2 ORDER BY 3 DESC, 4 DESC, 1, 2 LIMIT 24""",
)
def ordered_rank_rules(spark, sf):
    per_book = fx.sales_lines(spark, sf).groupBy("isbn13", "store_id").agg(F.sum("qty").alias("q"), F.count("*").alias("n"))
    per_house = per_book.join(fx.books_static(spark, sf).select("isbn13", "publisher"), "isbn13").groupBy("publisher", "store_id").agg(
        F.sum("q").alias("q"), F.sum("n").alias("train_rows")
    )
    rules = per_house.withColumn("multiplier", F.round(safe_ratio("q", "train_rows") / 25, 4)).drop("q")
    return rules.orderBy(F.desc("multiplier"), F.desc("train_rows"), "publisher", "store_id").limit(24)


# Training tables.


BOOK_DAYS = dict(
    keys=["isbn13"], day="feature_date", texts=["holiday_name", "season"],
    ints=["day_of_week", "month", "event_nearby_days", "sns_mentions_1d", "sns_mentions_7d", "book_age_days", "on_hand_total", "days_since_last_stockout"],
)


@query("features_build", digest_sql("book_features", **BOOK_DAYS))
def features_build(spark, sf):
    return digest(fx.book_features(spark, sf), **BOOK_DAYS)


@query("features_build_books", "SELECT * FROM features")
def features_build_books(spark, sf):
    return fx.features(spark, sf)


@query("training_dataset_wh", digest_sql("train_wh", **TRAIN_WH))
def training_dataset_wh(spark, sf):
    return digest(train_wh(spark, sf), **TRAIN_WH, daily=DAY_PARTS)


@query("training_dataset_store", digest_sql("train_store_all", **TRAIN_STORE))
def training_dataset_store(spark, sf):
    return digest(train_store(spark, sf), **TRAIN_STORE, daily=DAY_PARTS)


AUTOML = dict(
    keys=["series_id", "wh_id"], day="sale_date", floats=["avg_price"], texts=["season", "price_tier"],
    ints=["qty_sold", "revenue", "tx_count", "sns_mentions_1d", "sns_mentions_7d", "event_nearby_days", "day_of_week", "month", "category_id",
          "is_bestseller_flag", "author_experience_years"],
)


@query(
    "automl_input",
    digest_sql("""SELECT k.isbn13 || '_WH' || k.wh_id AS series_id, d.day AS sale_date, coalesce(s.qty_sold, 0) AS qty_sold, coalesce(s.revenue, 0) AS revenue,
              coalesce(s.avg_price, 0) AS avg_price, coalesce(s.tx_count, 0) AS tx_count, coalesce(f.sns_mentions_1d, 0) AS sns_mentions_1d,
              coalesce(f.sns_mentions_7d, 0) AS sns_mentions_7d, coalesce(f.is_holiday, false) AS is_holiday,
              coalesce(f.event_nearby_days, 0) AS event_nearby_days, f.season, f.day_of_week, f.month, coalesce(f.is_weekend, false) AS is_weekend,
              k.wh_id, b.category_id, b.price_tier, CAST(coalesce(b.is_bestseller_flag, false) AS INTEGER) AS is_bestseller_flag,
              coalesce(b.author_experience_years, 0) AS author_experience_years
       FROM (SELECT DISTINCT isbn13, wh_id FROM sales_fact) k CROSS JOIN sales_days d
       LEFT JOIN (SELECT isbn13, wh_id, sale_date, CAST(sum(qty_sold) AS BIGINT) AS qty_sold, CAST(sum(revenue) AS BIGINT) AS revenue,
                         avg(CAST(avg_price AS DOUBLE)) AS avg_price, CAST(sum(tx_count) AS BIGINT) AS tx_count
                  FROM sales_fact GROUP BY 1, 2, 3) s ON s.isbn13 = k.isbn13 AND s.wh_id = k.wh_id AND s.sale_date = d.day
       LEFT JOIN features f ON f.isbn13 = k.isbn13 AND f.feature_date = d.day LEFT JOIN books_static b ON b.isbn13 = k.isbn13""", **AUTOML),
)
def automl_input(spark, sf):
    wide = training.automl_input(
        fx.sales_fact(spark, sf), fx.features(spark, sf), fx.books_static(spark, sf), store_location_map(spark), locations_static(spark),
        fx.sale_period(spark, sf),
    )
    return digest(wide, **AUTOML)


SPLIT_SQL = """
SELECT *, CASE WHEN feature_date > (SELECT max(feature_date) FROM train_store) - 14 THEN 'holdout' ELSE 'train' END AS split_name FROM train_store
WHERE feature_date > (SELECT max(feature_date) FROM train_store) - 134 AND demand_segment IN ('high', 'medium')
  AND (feature_date > (SELECT max(feature_date) FROM train_store) - 14
       OR ('0x' || substr(md5(isbn13 || '#' || store_id || '#' || feature_date), 1, 8))::BIGINT % 100 < 25)
"""


@query("holdout_split", f"SELECT split_name, isbn13, store_id, feature_date, qty_sold, demand_segment FROM ({SPLIT_SQL})")
def holdout_split(spark, sf):
    split = training.holdout_split(train_store(spark, sf, STORE_DAYS, 134), newest=fx.newest_sale(spark, sf))
    return split.select("split_name", "isbn13", "store_id", "feature_date", "qty_sold", "demand_segment")


METRICS_SQL = """
SELECT count(*) AS row_count, count(DISTINCT isbn13 || '#' || wh_id) AS series_count, min(feature_date) AS min_feature_date,
       max(feature_date) AS max_feature_date, round(CAST(count(*) FILTER (qty_sold = 0) AS DOUBLE) / count(*), 4) AS zero_sales_ratio,
       round(CAST(count(*) FILTER (day_of_week IS NULL OR month IS NULL OR holiday_flag IS NULL OR weekend_flag IS NULL OR bestseller_flag IS NULL) AS DOUBLE)
             / count(*), 4) AS required_null_ratio FROM train_wh
"""


def wh_metrics(spark, sf):
    return gates.training_metrics(train_wh(spark, sf), WH)


@query("training_metrics", METRICS_SQL)
def training_metrics(spark, sf):
    return rounded(wh_metrics(spark, sf))


@query("training_publish", f"SELECT m.*, 'PASSED' AS validation_status, CAST(NULL AS VARCHAR) AS reject_reason, row_count AS published_rows FROM ({METRICS_SQL}) m")
def training_publish(spark, sf):
    base, newest = fresh_dir(spark, "training"), fx.newest_sale(spark, sf)
    audit = gates.publish_training(train_wh(spark, sf), base, newest, newest, max_zero_ratio=1.0)
    published = read_current(spark, base).agg(F.count(F.lit(1)).alias("published_rows"))
    return rounded(audit).join(published)


@query(
    "training_validation",
    f"""SELECT * EXCLUDE (r), CASE WHEN r = '' THEN 'PASSED' ELSE 'FAILED' END AS validation_status, nullif(r, '') AS reject_reason FROM (
          SELECT m.*, concat_ws(';', CASE WHEN row_count < 1000000 THEN 'row_count_below_threshold' END,
                 CASE WHEN series_count < 2000 THEN 'time_series_count_below_threshold' END,
                 CASE WHEN max_feature_date < (SELECT max(sale_date) FROM sales_lines) + 8 THEN 'training_data_stale' END,
                 CASE WHEN required_null_ratio > 0.01 THEN 'required_null_ratio_above_threshold' END,
                 CASE WHEN zero_sales_ratio > 0.995 THEN 'zero_sales_ratio_above_threshold' END) AS r FROM ({METRICS_SQL}) m)""",
)
def training_validation(spark, sf):
    run = F.date_add(fx.newest_sale(spark, sf), 9)
    return rounded(gates.training_validation(wh_metrics(spark, sf), run, min_rows=1_000_000, min_series=2_000))


@query(
    "staleness_guard",
    """SELECT max(feature_date) AS max_feature_date, (SELECT max(sale_date) FROM sales_lines) + 2 AS max_allowed_feature_date, true AS is_stale FROM panel_wh""",
)
def staleness_guard(spark, sf):
    run = F.date_add(fx.newest_sale(spark, sf), 3)
    stored = through_disk(spark, wh_panel(spark, sf), "panel")  # the guard looks at the table as it is stored
    return gates.staleness(stored, run)


@query(
    "forecast_quality",
    """SELECT q.*, (SELECT string_agg(target_date || '=' || n, ';' ORDER BY target_date) FROM (
                SELECT target_date, count(*) AS n FROM forecast_results f WHERE f.prediction_date = q.prediction_date GROUP BY 1)) AS target_date_row_counts,
              horizon_days = 5 AND null_predictions = 0 AND negative_predictions = 0 AND negative_lower_bounds = 0 AND invalid_intervals = 0 AS passed
       FROM (SELECT prediction_date, count(*) AS row_count, count(DISTINCT target_date) AS horizon_days, min(target_date) AS min_target_date,
                    max(target_date) AS max_target_date, count(DISTINCT isbn13) AS isbn_count, count(DISTINCT store_id) AS store_count,
                    count(*) FILTER (predicted_demand IS NULL) AS null_predictions, count(*) FILTER (predicted_demand < 0) AS negative_predictions,
                    count(*) FILTER (confidence_low < 0) AS negative_lower_bounds, count(*) FILTER (confidence_high < confidence_low) AS invalid_intervals
             FROM forecast_results GROUP BY 1) q""",
)
def forecast_quality(spark, sf):
    rows = fx.forecast_results(spark, sf)
    out = None
    for back in (0, 1):
        part = gates.forecast_quality(rows, F.date_sub(fx.newest_sale(spark, sf), back))
        out = part if out is None else out.unionByName(part)
    pairs = F.transform("target_date_row_counts", lambda x: F.concat_ws("=", x["target_date"].cast("string"), x["row_count"].cast("string")))
    return out.withColumn("target_date_row_counts", F.array_join(pairs, ";"))
