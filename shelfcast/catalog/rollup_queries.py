"""Aggregations (A1 to A11, A18 to A21, A25, A26) and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import fixtures as fx
from shelfcast.catalog.registry import query
from shelfcast.catalog.source_queries import YEARLY_SQL, yearly_events
from shelfcast.catalog.util import rounded
from shelfcast.domain import HOLIDAYS, MIN_ROWS, locations_static, store_location_map
from shelfcast.operators import calendar as cal
from shelfcast.operators import cleanse, rollups
from shelfcast.plans import models, policy, training

DAILY_SQL = """
SELECT sale_date, isbn13, store_id, channel, CAST(sum(qty) AS BIGINT) AS total_qty, CAST(sum(revenue) AS BIGINT) AS total_revenue,
       count(*) AS tx_count FROM sales_lines GROUP BY 1, 2, 3, 4
"""
KPI_SQL = """
SELECT a.*, t.isbn13 AS top_isbn FROM (
  SELECT sale_date AS kpi_date, store_id, channel, CAST(sum(qty) AS BIGINT) AS qty_sold, CAST(sum(revenue) AS BIGINT) AS revenue, count(*) AS tx_count,
         count(DISTINCT isbn13) AS unique_isbn_count, CAST(sum(revenue) // nullif(sum(qty), 0) AS BIGINT) AS avg_price FROM sales_lines GROUP BY 1, 2, 3) a
LEFT JOIN (SELECT sale_date, store_id, channel, isbn13, row_number() OVER (PARTITION BY sale_date, store_id, channel ORDER BY sum(qty) DESC, isbn13) AS rn
           FROM sales_lines GROUP BY 1, 2, 3, 4) t
  ON t.sale_date = a.kpi_date AND t.store_id = a.store_id AND t.channel = a.channel AND t.rn = 1
"""


def daily(spark, sf):
    return rollups.daily_sales(fx.sales_lines(spark, sf))


@query("sales_daily_agg", DAILY_SQL)
def sales_daily_agg(spark, sf):
    return daily(spark, sf)


@query(
    "daily_wh_sales",
    """SELECT s.sale_date AS feature_date, s.isbn13, CAST(l.wh_id AS BIGINT) AS wh_id, CAST(sum(s.qty_sold) AS BIGINT) AS qty_sold,
              CAST(sum(s.revenue) AS BIGINT) AS revenue, CAST(sum(s.tx_count) AS BIGINT) AS tx_count
       FROM sales_fact s JOIN store_location_map m ON m.store_id = s.store_id JOIN locations_static l ON l.location_id = m.location_id GROUP BY 1, 2, 3""",
)
def daily_wh_sales(spark, sf):
    return training.daily_warehouse_sales(fx.sales_fact(spark, sf), store_location_map(spark), locations_static(spark))


@query(
    "daily_wh_inventory",
    """SELECT i.snapshot_date AS feature_date, i.isbn13, CAST(l.wh_id AS BIGINT) AS wh_id, CAST(sum(i.on_hand) AS BIGINT) AS on_hand,
              CAST(sum(i.reserved_qty) AS BIGINT) AS reserved_qty
       FROM inventory_daily i JOIN locations_static l ON l.location_id = i.location_id GROUP BY 1, 2, 3""",
)
def daily_wh_inventory(spark, sf):
    return training.daily_warehouse_inventory(fx.inventory_daily(spark, sf), locations_static(spark))


@query("kpi_daily", KPI_SQL)
def kpi_daily(spark, sf):
    return rollups.kpi_daily(fx.sales_lines(spark, sf))


@query(
    "kpi_company_rollup",
    f"""SELECT kpi_date, store_id, channel, qty_sold, revenue, tx_count, unique_isbn_count, avg_price, top_isbn FROM ({KPI_SQL})
        UNION ALL SELECT a.*, t.isbn13 FROM (
          SELECT sale_date, CAST(0 AS BIGINT), 'ALL', CAST(sum(qty) AS BIGINT), CAST(sum(revenue) AS BIGINT), count(*), count(DISTINCT isbn13),
                 CAST(sum(revenue) // nullif(sum(qty), 0) AS BIGINT) FROM sales_lines GROUP BY 1) a
        JOIN (SELECT sale_date, isbn13, row_number() OVER (PARTITION BY sale_date ORDER BY sum(qty) DESC, isbn13) AS rn FROM sales_lines GROUP BY 1, 2) t
          ON t.sale_date = a.sale_date AND t.rn = 1""",
)
def kpi_company_rollup(spark, sf):
    return rollups.with_company_total(fx.sales_lines(spark, sf))


@query(
    "branch_inventory_summary",
    """SELECT l.location_id, l.name AS location_name, l.region, l.location_type, count(DISTINCT i.isbn13) AS distinct_books, CAST(sum(i.on_hand) AS BIGINT) AS total_qty
       FROM locations_static l LEFT JOIN inventory i ON i.location_id = l.location_id GROUP BY 1, 2, 3, 4""",
)
def branch_inventory_summary(spark, sf):
    return rollups.branch_inventory(fx.inventory(spark, sf), locations_static(spark))


@query(
    "wh_forecast_rollup",
    """SELECT CAST(l.wh_id AS BIGINT) AS wh_id, f.isbn13, f.target_date, f.prediction_date, round(sum(f.predicted_demand), 4) AS predicted_demand,
              round(sum(f.confidence_low), 4) AS confidence_low, round(sum(f.confidence_high), 4) AS confidence_high
       FROM forecast_results f JOIN store_location_map m ON m.store_id = f.store_id JOIN locations_static l ON l.location_id = m.inventory_location_id
       GROUP BY 1, 2, 3, 4""",
)
def wh_forecast_rollup(spark, sf):
    return rounded(policy.roll_up_to_warehouse(fx.forecast_results(spark, sf), store_location_map(spark), locations_static(spark)))


@query(
    "wh_forecast_append",
    """SELECT prediction_date, target_date, isbn13, store_id, predicted_demand, confidence_low, confidence_high, model_version FROM forecast_results
       UNION ALL SELECT f.prediction_date, f.target_date, f.isbn13, CAST(14 + l.wh_id AS BIGINT), round(sum(coalesce(f.predicted_demand, 0)), 4),
              round(sum(coalesce(f.predicted_demand, 0)) * 0.85, 4), round(sum(coalesce(f.predicted_demand, 0)) * 1.15, 4), 'wh-aggregate'
       FROM forecast_results f JOIN locations_static l ON l.location_id = f.store_id GROUP BY 1, 2, 3, 4""",
)
def wh_forecast_append(spark, sf):
    return policy.append_warehouse_rows(fx.forecast_results(spark, sf), locations_static(spark), digits=4)


@query("sku_top_n", f"SELECT isbn13, CAST(sum(total_qty) AS BIGINT) AS total_sold FROM ({DAILY_SQL}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def sku_top_n(spark, sf):
    return rollups.top_sellers(daily(spark, sf))


@query("channel_mix", f"SELECT channel, CAST(sum(total_revenue) AS BIGINT) AS revenue, CAST(sum(total_qty) AS BIGINT) AS qty FROM ({DAILY_SQL}) GROUP BY 1")
def channel_mix(spark, sf):
    return rollups.channel_mix(daily(spark, sf))


@query(
    "feature_profile",
    """SELECT count(*) AS row_count, count(DISTINCT isbn13) AS isbn_count, round(avg(sns_mentions_1d), 4) AS avg_sns,
              round(avg(on_hand_total), 4) AS avg_on_hand_total FROM features""",
)
def feature_profile(spark, sf):
    return rounded(rollups.feature_profile(fx.features(spark, sf)))


@query("spike_seed_profile", "SELECT is_spike_seed, count(*) AS cnt, round(avg(mention_count), 4) AS avg_mentions FROM sns_mentions GROUP BY 1")
def spike_seed_profile(spark, sf):
    return rounded(rollups.spike_seed_profile(cleanse.clean_sns(fx.sns_raw(spark, sf))))


@query(
    "early_demand",
    """SELECT s.isbn13, s.store_id, round(avg(CAST(s.qty_sold AS DOUBLE)), 4) AS avg_daily_demand FROM sales_fact s
       JOIN (SELECT isbn13, min(sale_date) AS d FROM sales_fact GROUP BY 1) f ON f.isbn13 = s.isbn13
       WHERE s.sale_date BETWEEN f.d AND f.d + 30 GROUP BY 1, 2""",
)
def early_demand(spark, sf):
    return rounded(models.early_demand(fx.sales_fact(spark, sf)))


SCORE_SQL = "SELECT isbn13, store_id, sum(qty) % 13 / 4.0 - 0.5 AS score FROM sales_lines GROUP BY 1, 2"


def simple_scores(spark, sf):
    return fx.sales_lines(spark, sf).groupBy("isbn13", "store_id").agg((F.sum("qty") % 13 / F.lit(4.0) - 0.5).alias("score"))


@query(
    "new_book_wh_qty",
    f"""SELECT isbn13, CAST(wh_id AS BIGINT) AS wh_id, CAST(sum(q) AS BIGINT) AS qty
        FROM (SELECT s.isbn13, l.wh_id, CAST(round(greatest(s.score, 0) * 30) AS BIGINT) AS q FROM ({SCORE_SQL}) s
              JOIN store_location_map m ON m.store_id = s.store_id JOIN locations_static l ON l.location_id = m.inventory_location_id) GROUP BY 1, 2""",
)
def new_book_wh_qty(spark, sf):
    return models.new_book_wh_quantity(
        models.new_book_quantities(simple_scores(spark, sf), store_location_map(spark), locations_static(spark))
    )


@query("order_type_status", "SELECT order_type, status, count(*) AS order_count, CAST(sum(qty) AS BIGINT) AS total_qty FROM pending_orders GROUP BY 1, 2")
def order_type_status(spark, sf):
    return rollups.order_counts(fx.pending_orders(spark, sf))


@query(
    "order_funnel",
    """SELECT CAST(created_at AS DATE) AS order_date, count(*) FILTER (status = 'REJECTED') AS rejected,
              count(*) FILTER (status IN ('APPROVED', 'IN_TRANSIT')) AS approved, count(*) FILTER (status IN ('EXECUTED', 'AUTO_EXECUTED')) AS executed,
              count(*) FILTER (status = 'PENDING') AS pending FROM pending_orders GROUP BY 1""",
)
def order_funnel(spark, sf):
    return rollups.order_funnel(fx.pending_orders(spark, sf))


@query("store_id_census", "SELECT store_id, wh_id, count(*) AS row_count FROM sales_lines GROUP BY 1, 2")
def store_id_census(spark, sf):
    return rollups.count_by(fx.sales_lines(spark, sf), ["store_id", "wh_id"]).orderBy("store_id")


@query(
    "min_row_check",
    """SELECT t.*, t.row_count >= t.min_rows AS is_enough FROM (
         SELECT 'books' AS table_name, count(*) AS row_count, 1000 AS min_rows FROM books_static
         UNION ALL SELECT 'locations', count(*), 12 FROM locations_static UNION ALL SELECT 'inventory', count(*), 1000 FROM inventory
         UNION ALL SELECT 'publishers', count(DISTINCT publisher), 30 FROM books_static
         UNION ALL SELECT 'forecast_cache', count(*), 100 FROM forecast_results UNION ALL SELECT 'pending_orders', count(*), 10 FROM pending_orders) t""",
)
def min_row_check(spark, sf):
    tables = {
        "books": fx.books_static(spark, sf),
        "locations": locations_static(spark),
        "inventory": fx.inventory(spark, sf),
        "publishers": cleanse.publisher_table(fx.books_static(spark, sf)),
        "forecast_cache": fx.forecast_results(spark, sf),
        "pending_orders": fx.pending_orders(spark, sf),
    }
    return rollups.check_min_rows(spark, tables, MIN_ROWS)


@query(
    "publisher_top",
    "SELECT publisher, count(*) AS book_count, round(avg(price), 4) AS avg_price FROM catalog_raw GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def publisher_top(spark, sf):
    return rounded(rollups.catalog_counts(fx.catalog_raw(spark, sf)))


@query("catalog_query_counts", "SELECT synced_at, category_name, count(*) AS book_count FROM catalog_raw GROUP BY 1, 2")
def catalog_query_counts(spark, sf):
    return rollups.count_by(fx.catalog_raw(spark, sf), ["synced_at", "category_name"], "book_count")


@query(
    "safety_stock",
    f"""WITH d AS (SELECT s.isbn13, s.store_id, greatest(s.score, 0) AS demand, l.wh_id FROM ({SCORE_SQL}) s
                   JOIN locations_static l ON l.location_id = s.store_id AND NOT l.is_virtual)
        SELECT isbn13, store_id AS location_id, CAST(greatest(floor(demand * 5), 5) AS BIGINT) AS safety_stock FROM d
        UNION ALL SELECT isbn13, CAST(14 + wh_id AS BIGINT), CAST(greatest(floor(sum(demand) * 5), 5) AS BIGINT) FROM d GROUP BY isbn13, wh_id""",
)
def safety_stock(spark, sf):
    demand = simple_scores(spark, sf).select("isbn13", "store_id", F.greatest("score", F.lit(0.0)).alias("demand"))
    return rollups.safety_stock(demand, locations_static(spark))


@query("distinct_series", "SELECT DISTINCT isbn13, wh_id, store_id FROM sales_lines")
def distinct_series(spark, sf):
    return fx.sales_lines(spark, sf).select("isbn13", "wh_id", "store_id").distinct()


@query(
    "union_by_name",
    f"""WITH y AS ({YEARLY_SQL}) SELECT event_type AS title, start_date AS day, end_date, CAST(NULL AS VARCHAR) AS order_id FROM y
        UNION ALL SELECT holiday_name, holiday_date, NULL, NULL FROM holidays
        UNION ALL SELECT order_type, CAST(created_at AS DATE), NULL, order_id FROM pending_orders""",
)
def union_by_name(spark, sf):
    trade = yearly_events(spark, sf).select(F.col("event_type").alias("title"), F.col("start_date").alias("day"), "end_date")
    off = cal.holiday_dates(spark, fx.literal_bounds(spark, sf), HOLIDAYS).select(F.col("holiday_date").alias("day"), F.col("holiday_name").alias("title"))
    orders = fx.pending_orders(spark, sf).select("order_id", F.col("order_type").alias("title"), F.to_date("created_at").alias("day"))
    return cleanse.union_all_by_name([trade, off, orders])
