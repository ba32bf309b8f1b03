"""Joins (J1 to J15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import fixtures as fx
from shelfcast.catalog.cleanse_queries import CANDIDATE_SQL, candidates
from shelfcast.catalog.reference_sql import ISBN
from shelfcast.catalog.registry import query
from shelfcast.catalog.util import digest, digest_sql
from shelfcast.domain import locations_static, store_location_map
from shelfcast.operators import enrich
from shelfcast.operators.series import densify
from shelfcast.plans import models, policy, training


@query(
    "training_view",
    """SELECT s.sale_date, s.isbn13, s.store_id, s.qty_sold, b.category_id, b.category_name, b.publisher, b.author, b.price_tier,
              b.sales_point, b.item_page, l.location_type, l.wh_id, l.size, l.is_virtual, f.is_holiday, f.season, f.day_of_week,
              f.is_weekend, f.month, f.event_nearby_days, f.sns_mentions_1d, f.sns_mentions_7d, f.on_hand_total,
              f.days_since_last_stockout, f.book_age_days, f.is_bestseller_flag, i.on_hand, i.reserved_qty
       FROM sales_fact s LEFT JOIN features f ON f.isbn13 = s.isbn13 AND f.feature_date = s.sale_date
       LEFT JOIN books_static b ON b.isbn13 = s.isbn13 LEFT JOIN locations_static l ON l.location_id = s.store_id
       LEFT JOIN inventory_daily i ON i.isbn13 = s.isbn13 AND i.snapshot_date = s.sale_date AND i.location_id = l.location_id""",
)
def training_view(spark, sf):
    return enrich.training_view(
        fx.sales_fact(spark, sf), fx.features(spark, sf), fx.books_static(spark, sf), locations_static(spark), fx.inventory_daily(spark, sf)
    )


@query(
    "wh_resolve",
    """SELECT s.sale_date, s.isbn13, s.store_id, coalesce(CAST(l.wh_id AS BIGINT), s.wh_id) AS wh_id, s.qty_sold
       FROM (SELECT * REPLACE (CASE WHEN store_id % 5 = 0 THEN 99 ELSE store_id END AS store_id) FROM sales_fact) s
       LEFT JOIN store_location_map m ON m.store_id = s.store_id LEFT JOIN locations_static l ON l.location_id = m.location_id""",
)
def wh_resolve(spark, sf):
    # Store 99 is not in the map, so its rows keep their own warehouse.
    closed = F.when(F.col("store_id") % 5 == 0, 99).otherwise(F.col("store_id"))
    sales = fx.sales_fact(spark, sf).withColumn("store_id", closed).select("sale_date", "isbn13", "store_id", "wh_id", "qty_sold")
    return training.resolve_warehouse(sales, store_location_map(spark), locations_static(spark))


SPINE = dict(keys=["isbn13", "wh_id"], day="feature_date", ints=["qty"])


@query(
    "spine_cross",
    digest_sql("""SELECT k.isbn13, k.wh_id, d.day AS feature_date, coalesce(s.qty, 0) AS qty
       FROM (SELECT DISTINCT isbn13, wh_id FROM sales_fact) k CROSS JOIN sales_days d
       LEFT JOIN (SELECT isbn13, wh_id, sale_date, CAST(sum(qty_sold) AS BIGINT) AS qty FROM sales_fact GROUP BY 1, 2, 3) s
         ON s.isbn13 = k.isbn13 AND s.wh_id = k.wh_id AND s.sale_date = d.day""", **SPINE),
)
def spine_cross(spark, sf):
    sales = fx.sales_fact(spark, sf)
    daily = sales.groupBy("isbn13", "wh_id", F.col("sale_date").alias("feature_date")).agg(F.sum("qty_sold").alias("qty"))
    return digest(densify(daily, ["isbn13", "wh_id"], "feature_date", ["qty"], *fx.sale_period(spark, sf)), **SPINE)


PANEL_SQL = """
SELECT d.day AS feature_date, k.isbn13, k.wh_id, coalesce(s.qty_sold, 0) AS qty_sold, coalesce(i.on_hand, 0) AS on_hand,
       coalesce(i.reserved_qty, 0) AS reserved_qty
FROM (SELECT DISTINCT isbn13, wh_id FROM sales_fact) k CROSS JOIN sales_days d
LEFT JOIN (SELECT sale_date, isbn13, wh_id, CAST(sum(qty_sold) AS BIGINT) AS qty_sold FROM sales_fact GROUP BY 1, 2, 3) s
  ON s.sale_date = d.day AND s.isbn13 = k.isbn13 AND s.wh_id = k.wh_id
LEFT JOIN (SELECT i.snapshot_date, i.isbn13, l.wh_id, CAST(sum(i.on_hand) AS BIGINT) AS on_hand, CAST(sum(i.reserved_qty) AS BIGINT) AS reserved_qty
           FROM inventory_daily i JOIN locations_static l ON l.location_id = i.location_id GROUP BY 1, 2, 3) i
  ON i.snapshot_date = d.day AND i.isbn13 = k.isbn13 AND i.wh_id = k.wh_id
"""
COVARIATE_SQL = """
CAST(coalesce(f.is_holiday, false) AS INTEGER) AS holiday_flag, coalesce(f.day_of_week, dayofweek(p.feature_date) + 1) AS day_of_week,
coalesce(f.month, month(p.feature_date)) AS month, CAST(coalesce(f.is_weekend, dayofweek(p.feature_date) IN (0, 6)) AS INTEGER) AS weekend_flag,
coalesce(f.event_nearby_days, 0) AS event_nearby_days, coalesce(f.sns_mentions_1d, 0) AS sns_mentions_1d,
coalesce(f.sns_mentions_7d, 0) AS sns_mentions_7d, coalesce(f.book_age_days, 0) AS book_age_days,
coalesce(f.days_since_last_stockout, 0) AS days_since_last_stockout, b.category_id, b.price_tier, coalesce(b.sales_point, 0) AS sales_point,
CAST(coalesce(b.is_bestseller_flag, false) AS INTEGER) AS bestseller_flag, coalesce(b.author_experience_years, 0) AS author_experience_years
"""
ENRICHED_SQL = f"""
SELECT p.*, {COVARIATE_SQL} FROM ({PANEL_SQL}) p
LEFT JOIN features f ON f.isbn13 = p.isbn13 AND f.feature_date = p.feature_date LEFT JOIN books_static b ON b.isbn13 = p.isbn13
"""


def wh_panel(spark, sf, last=None, windows=None):
    return training.warehouse_panel(
        fx.sales_fact(spark, sf), fx.inventory_daily(spark, sf), store_location_map(spark), locations_static(spark),
        period=fx.sale_period(spark, sf, last), windows=windows,
    )


PANEL_INTS = ["qty_sold", "on_hand", "reserved_qty"]
COVARIATE_INTS = [
    "holiday_flag", "day_of_week", "month", "weekend_flag", "event_nearby_days", "sns_mentions_1d", "sns_mentions_7d", "book_age_days",
    "days_since_last_stockout", "category_id", "sales_point", "bestseller_flag", "author_experience_years",
]
#: Covariates that follow from the date, and so differ from day to day.
DAY_PARTS = ["day_of_week", "month", "weekend_flag"]
ENRICHED = dict(keys=["isbn13", "wh_id"], day="feature_date", ints=PANEL_INTS + COVARIATE_INTS, texts=["price_tier"])


@query("dense_enrich", digest_sql(ENRICHED_SQL, **ENRICHED))
def dense_enrich(spark, sf):
    panel = training.enriched_warehouse_panel(
        fx.sales_fact(spark, sf), fx.inventory_daily(spark, sf), fx.features(spark, sf), store_location_map(spark), locations_static(spark),
        period=fx.sale_period(spark, sf), books=fx.books_static(spark, sf),
    )
    return digest(panel, **ENRICHED, daily=DAY_PARTS)


@query(
    "online_available",
    """SELECT o.location_id AS online_location_id, o.name AS online_location_name, o.wh_id, w.location_id AS wh_location_id, i.isbn13,
              greatest(i.on_hand - i.reserved_qty, 0) AS available
       FROM locations_static o JOIN locations_static w ON w.wh_id = o.wh_id AND w.location_type = 'WH' JOIN inventory i ON i.location_id = w.location_id
       WHERE o.location_type = 'STORE_ONLINE' AND o.is_virtual AND o.active""",
)
def online_available(spark, sf):
    return enrich.online_available(fx.inventory(spark, sf), locations_static(spark))


@query(
    "inventory_available",
    """SELECT i.*, l.location_type, l.wh_id, l.name AS location_name, greatest(i.on_hand - i.reserved_qty, 0) AS available
       FROM inventory i JOIN locations_static l ON l.location_id = i.location_id WHERE l.active""",
)
def inventory_available(spark, sf):
    return enrich.inventory_available(fx.inventory(spark, sf), locations_static(spark))


@query(
    "orphan_check",
    f"""SELECT 'order_book' AS check_name, count(*) AS orphans FROM (SELECT {ISBN.format('o_custkey * 3')} AS isbn13 FROM orders) o
        WHERE NOT EXISTS (SELECT 1 FROM books_static b WHERE b.isbn13 = o.isbn13)
        UNION ALL SELECT 'sale_book', count(*) FROM sales_lines s WHERE NOT EXISTS (SELECT 1 FROM books_static b WHERE b.isbn13 = s.isbn13)
        UNION ALL SELECT 'inventory_location', count(*) FROM inventory i WHERE NOT EXISTS (SELECT 1 FROM locations_static l WHERE l.location_id = i.location_id)""",
)
def orphan_check(spark, sf):
    books, places = fx.books_static(spark, sf), locations_static(spark)
    ordered = fx.table(spark, sf, "orders").select((F.col("o_custkey") * 3).alias("k")).select(fx.isbn("k").alias("isbn13"))
    checks = {
        "order_book": enrich.count_orphans(ordered, books, "isbn13"),
        "sale_book": enrich.count_orphans(fx.sales_lines(spark, sf), books, "isbn13"),
        "inventory_location": enrich.count_orphans(fx.inventory(spark, sf), places, "location_id"),
    }
    out = None
    for name, df in checks.items():
        part = df.select(F.lit(name).alias("check_name"), "orphans")
        out = part if out is None else out.unionByName(part)
    return out


@query("new_book_candidates", CANDIDATE_SQL)
def new_book_candidates(spark, sf):
    return candidates(spark, sf)


@query(
    "new_book_features",
    """SELECT b.isbn13, b.category_id, b.price_tier, coalesce(b.sales_point, 0) AS sales_point, CAST(b.is_bestseller_flag AS INTEGER) AS is_bestseller_flag,
              b.author_experience_years, b.author_past_books_count, b.item_page, CAST(m.store_id AS BIGINT) AS store_id,
              CAST(coalesce(l.wh_id, 1) AS BIGINT) AS region_code, CASE l.size WHEN 'L' THEN 3 WHEN 'M' THEN 2 WHEN 'S' THEN 1 ELSE 2 END AS size_numeric
       FROM books_static b CROSS JOIN store_location_map m LEFT JOIN locations_static l ON l.location_id = m.location_id""",
)
def new_book_features(spark, sf):
    return models.new_book_grid(fx.books_static(spark, sf), store_location_map(spark), locations_static(spark))


SLICE_SQL = """
SELECT target_date AS snapshot_date, isbn13, store_id, predicted_demand, confidence_low, confidence_high, model_version
FROM forecast_results WHERE prediction_date = (SELECT max(prediction_date) FROM forecast_results)
  AND target_date >= (SELECT max(target_date) FROM forecast_results
                      WHERE prediction_date = (SELECT max(prediction_date) FROM forecast_results)) - 2
"""


@query("latest_run_slice", SLICE_SQL)
def latest_run_slice(spark, sf):
    return policy.latest_run_slice(fx.forecast_results(spark, sf), 2).orderBy("snapshot_date", "store_id", "isbn13")


@query(
    "approval_join",
    """SELECT o.order_id, o.order_type, o.status, a.approval_side, a.decision, a.decided_at FROM pending_orders o
       JOIN order_approvals a ON a.order_id = o.order_id""",
)
def approval_join(spark, sf):
    return enrich.approvals_of_orders(fx.pending_orders(spark, sf), fx.order_approvals(spark, sf)).orderBy("decided_at", "order_id")


@query(
    "spike_tracked_join",
    """SELECT b.isbn13, b.baseline_lam, coalesce(c.n, 0) AS mentions_count
       FROM (SELECT isbn13, CASE WHEN partkey % 3 = 0 THEN NULL ELSE CAST(1 + partkey % 20 AS DOUBLE) END AS baseline_lam FROM books_static) b
       LEFT JOIN (SELECT isbn13, count(*) AS n FROM sns_raw GROUP BY 1) c ON c.isbn13 = b.isbn13""",
)
def spike_tracked_join(spark, sf):
    counts = fx.sns_raw(spark, sf).groupBy("isbn13").agg(F.count("*").alias("mentions_count"))
    return enrich.tracked_counts(baselines(spark, sf), counts)


def baselines(spark, sf):
    key = F.col("partkey")
    return fx.books_static(spark, sf).select("isbn13", F.when(key % 3 != 0, (1 + key % 20).cast("double")).alias("baseline_lam"))


@query(
    "cooldown_anti",
    f"""WITH e AS (SELECT {ISBN.format('user_id')} AS isbn13, event_id, event_type, date_trunc('second', ts) AS detected_at FROM events)
        SELECT c.event_id, c.isbn13, c.detected_at FROM e c WHERE c.event_type = 'view' AND NOT EXISTS (
          SELECT 1 FROM e h WHERE h.event_type = 'click' AND h.isbn13 = c.isbn13 AND h.detected_at < c.detected_at
            AND h.detected_at > c.detected_at - INTERVAL 30 MINUTE)""",
)
def cooldown_anti(spark, sf):
    rows = fx.table(spark, sf, "events").select(
        "event_id", "event_type", fx.isbn("user_id").alias("isbn13"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("detected_at")
    )
    found, past = rows.filter("event_type = 'view'").drop("event_type"), rows.filter("event_type = 'click'")
    return enrich.without_recent(found, past, "isbn13", "detected_at", 30)


@query(
    "stock_source_resolve",
    """SELECT s.txn_id, s.isbn13, s.store_id, CAST(CASE WHEN l.location_type = 'STORE_ONLINE' THEN w.location_id ELSE s.store_id END AS BIGINT) AS debit_location_id,
              s.qty FROM sales_lines s LEFT JOIN locations_static l ON l.location_id = s.store_id
       LEFT JOIN locations_static w ON w.location_type = 'WH' AND w.wh_id = l.wh_id""",
)
def stock_source_resolve(spark, sf):
    sales = fx.sales_lines(spark, sf).select("txn_id", "isbn13", "store_id", "qty")
    return enrich.stock_location(sales, locations_static(spark))


@query(
    "dual_approval_ready",
    """SELECT o.order_id, o.order_type, o.status, CASE WHEN two THEN 2 ELSE 1 END AS sides_required,
              CAST(CASE WHEN two THEN coalesce(g.s + g.t, 0) ELSE coalesce(g.y, 0) END AS INTEGER) AS sides_approved,
              coalesce(CASE WHEN two THEN g.s = 1 AND g.t = 1 ELSE g.y = 1 END, false) AS is_ready
       FROM (SELECT *, order_type IN ('WH_TRANSFER', 'REBALANCE') AS two FROM pending_orders) o
       LEFT JOIN (SELECT order_id, max(CASE WHEN decision = 'APPROVED' AND approval_side = 'SOURCE' THEN 1 ELSE 0 END) AS s,
                         max(CASE WHEN decision = 'APPROVED' AND approval_side = 'TARGET' THEN 1 ELSE 0 END) AS t,
                         max(CASE WHEN decision = 'APPROVED' THEN 1 ELSE 0 END) AS y FROM order_approvals GROUP BY 1) g ON g.order_id = o.order_id""",
)
def dual_approval_ready(spark, sf):
    return enrich.approval_state(fx.pending_orders(spark, sf), fx.order_approvals(spark, sf))
