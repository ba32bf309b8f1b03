"""The domain tables of ``fixtures.py`` in plain SQL, for comparison runs."""

from __future__ import annotations

from shelfcast.domain import (
    HOLIDAYS,
    LOCATION_COLUMNS,
    LOCATIONS,
    STORE_MAP_COLUMNS,
    YEARLY_EVENTS,
    store_map_rows,
    values_sql,
)

ISBN = "'978' || lpad(CAST({} AS VARCHAR), 10, '0')"

TABLES: dict = {}

TABLES["locations_static"] = values_sql(LOCATIONS, LOCATION_COLUMNS)
TABLES["store_location_map"] = values_sql(store_map_rows(), STORE_MAP_COLUMNS)
TABLES["holiday_days"] = values_sql(HOLIDAYS, ["h_month", "h_day", "holiday_name"])
TABLES["yearly_events"] = values_sql(YEARLY_EVENTS, ["event_type", "e_month", "e_day", "e_days"])

TABLES["sales_lines"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS txn_id,
       l_partkey AS partkey, {ISBN.format('l_partkey')} AS isbn13,
       CAST(l_shipdate AS DATE) AS sale_date, CAST(l_suppkey % 14 + 1 AS BIGINT) AS store_id,
       CAST(CASE WHEN l_suppkey % 14 + 1 <= 6 OR l_suppkey % 14 + 1 = 13 THEN 1 ELSE 2 END AS BIGINT) AS wh_id,
       CASE WHEN l_suppkey % 14 + 1 >= 13 THEN 'online' ELSE 'offline' END AS channel,
       CAST(l_quantity AS BIGINT) AS qty,
       CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT) AS revenue
FROM lineitem
"""
TABLES["sales_fact"] = """
SELECT sale_date, isbn13, store_id, wh_id, channel, CAST(sum(qty) AS BIGINT) AS qty_sold,
       CAST(sum(revenue) AS BIGINT) AS revenue, CAST(sum(revenue) // sum(qty) AS BIGINT) AS avg_price,
       count(*) AS tx_count
FROM sales_lines GROUP BY sale_date, isbn13, store_id, wh_id, channel
"""
TABLES["books_static"] = f"""
SELECT p_partkey AS partkey, {ISBN.format('p_partkey')} AS isbn13, p_name AS title,
       CAST(p_size AS BIGINT) AS category_id, p_type AS category_name, p_brand AS publisher,
       CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_name || ', ' || p_type
            WHEN p_partkey % 3 = 1 THEN p_name || '; ' || p_brand ELSE p_name END AS author,
       DATE '1994-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS pub_date,
       CAST(floor(p_retailprice * 20) AS BIGINT) + (p_partkey % 5 - 2) * 4000 AS price_standard,
       CASE WHEN p_partkey % 29 = 0 THEN NULL
            ELSE CAST(floor(p_retailprice * 18) AS BIGINT) + (p_partkey % 5 - 2) * 4000 END AS price_sales,
       CASE WHEN CAST(floor(p_retailprice * 20) AS BIGINT) + (p_partkey % 5 - 2) * 4000 < 10000 THEN 'LOW'
            WHEN CAST(floor(p_retailprice * 20) AS BIGINT) + (p_partkey % 5 - 2) * 4000 < 20000 THEN 'MID'
            ELSE 'HIGH' END AS price_tier,
       p_partkey * 37 % 100000 AS sales_point, p_partkey * 37 % 100000 >= 50000 AS is_bestseller_flag,
       p_partkey % 40 AS author_experience_years, p_partkey % 12 AS author_past_books_count,
       90 + p_partkey % 700 AS item_page,
       CASE WHEN p_partkey % 7 = 0 THEN 'PUBLISHER_REQUEST' ELSE 'CATALOG' END AS source,
       p_partkey % 11 <> 0 AS active
FROM part
"""
TABLES["inventory"] = """
SELECT b.isbn13, CAST(l.location_id AS BIGINT) AS location_id,
       (b.partkey * 31 + l.location_id * 17) % 200 AS on_hand,
       (b.partkey * 31 + l.location_id * 17) % 200 % 11 AS reserved_qty, 5 + b.partkey % 20 AS safety_stock
FROM books_static b, locations_static l WHERE NOT l.is_virtual
"""
TABLES["inventory_daily"] = """
SELECT DISTINCT s.sale_date AS snapshot_date, s.isbn13, CAST(m.inventory_location_id AS BIGINT) AS location_id,
       (s.partkey * 31 + m.inventory_location_id * 17 + (s.sale_date - DATE '1995-01-01') * 7) % 40 AS on_hand,
       (s.partkey * 31 + m.inventory_location_id * 17 + (s.sale_date - DATE '1995-01-01') * 7) % 40 % 11 AS reserved_qty,
       5 + s.partkey % 20 AS safety_stock
FROM sales_lines s JOIN store_location_map m ON m.store_id = s.store_id
"""
TABLES["sales_days"] = """
SELECT CAST(unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY)) AS DATE) AS day FROM sales_lines
"""
TABLES["holidays"] = """
SELECT day AS holiday_date, holiday_name FROM (
  SELECT CAST(unnest(generate_series(min(sale_date), max(sale_date) + 30, INTERVAL 1 DAY)) AS DATE) AS day
  FROM sales_lines)
JOIN holiday_days ON h_month = month(day) AND h_day = day(day)
"""
TABLES["calendar"] = """
SELECT d.day, h.holiday_name IS NOT NULL AS is_holiday, coalesce(h.holiday_name, '') AS holiday_name,
       CASE WHEN month(d.day) IN (3, 4, 5) THEN 'SPRING' WHEN month(d.day) IN (6, 7, 8) THEN 'SUMMER'
            WHEN month(d.day) IN (9, 10, 11) THEN 'FALL' ELSE 'WINTER' END AS season,
       dayofweek(d.day) + 1 AS day_of_week, dayofweek(d.day) IN (0, 6) AS is_weekend,
       CAST(month(d.day) AS BIGINT) AS month,
       coalesce((SELECT min(x.holiday_date - d.day) FROM holidays x
                 WHERE x.holiday_date > d.day AND x.holiday_date <= d.day + 30), 0) AS event_nearby_days
FROM sales_days d LEFT JOIN holidays h ON h.holiday_date = d.day
"""
TABLES["pos_raw"] = f"""
SELECT CAST(event_id AS VARCHAR) AS tx_id,
       CASE WHEN event_id % 97 = 0 THEN 'X' || CAST(user_id AS VARCHAR) ELSE {ISBN.format('user_id')} END AS isbn13,
       CAST((event_id + copy_no) % 5 AS INTEGER) AS qty, CAST(floor(value * 1000) AS BIGINT) AS unit_price,
       CAST((event_id + copy_no) % 5 * floor(value * 1000) AS BIGINT) AS total_price,
       CASE WHEN user_id % 14 + 1 >= 13 THEN 'online' ELSE 'offline' END AS channel,
       CAST(user_id % 14 + 1 AS INTEGER) AS location_id,
       CASE WHEN event_id % 89 = 0 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts
FROM events, (VALUES (0), (1)) AS c(copy_no)
WHERE event_type = 'purchase' AND (copy_no = 0 OR event_id % 50 = 0)
"""
TABLES["pos_clean_rows"] = """
SELECT tx_id, isbn13, qty, unit_price, total_price, channel, location_id, ts, CAST(ts AS DATE) AS sale_date,
       CAST(hour(ts) AS INTEGER) AS sale_hour
FROM (SELECT tx_id, isbn13, qty, unit_price, total_price, channel, location_id,
             TRY_CAST(ts AS TIMESTAMP) AS ts,
             row_number() OVER (PARTITION BY tx_id ORDER BY TRY_CAST(ts AS TIMESTAMP) NULLS FIRST, isbn13, qty) AS rn
      FROM pos_raw)
WHERE rn = 1 AND qty > 0 AND regexp_full_match(isbn13, '[0-9]{13}')
"""
TABLES["sns_raw"] = f"""
SELECT CAST(event_id AS VARCHAR) AS mention_id,
       CASE WHEN event_id % 97 = 0 THEN 'X' || CAST(user_id AS VARCHAR) ELSE {ISBN.format('user_id')} END AS isbn13,
       CASE event_type WHEN 'view' THEN 'blog' ELSE 'feed' END AS platform,
       json_extract_string(props, '$.k') AS mention_count, value AS sentiment_score,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS collected_at
FROM events WHERE event_type IN ('view', 'click')
"""
TABLES["sns_mentions"] = """
SELECT mention_id, isbn13, platform, TRY_CAST(mention_count AS INTEGER) AS mention_count,
       CAST(sentiment_score AS DOUBLE) AS sentiment_score, TRY_CAST(collected_at AS TIMESTAMP) AS collected_at,
       CAST(TRY_CAST(collected_at AS TIMESTAMP) AS DATE) AS mention_date,
       TRY_CAST(mention_count AS INTEGER) >= 10 AS is_spike_seed
FROM sns_raw WHERE regexp_full_match(isbn13, '[0-9]{13}')
"""
TABLES["sns_daily"] = f"""
SELECT {ISBN.format('user_id')} AS isbn13, (SELECT min(sale_date) FROM sales_lines) + CAST(event_id % 2499 AS INTEGER) AS mention_date,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS mentions
FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2
"""
TABLES["catalog_raw"] = f"""
SELECT CASE WHEN p_partkey % 97 = 0 THEN '97' || CAST(p_partkey AS VARCHAR) ELSE {ISBN.format('p_partkey')} END AS isbn13,
       p_name AS title, p_brand AS publisher, CAST(p_size AS VARCHAR) AS category_id, p_type AS category_name,
       CAST(CASE WHEN v = 1 AND p_partkey % 2 = 0 THEN floor(p_retailprice) + 10 ELSE floor(p_retailprice) END AS BIGINT) AS price,
       p_partkey * 37 % 100000 AS sales_point,
       CASE v WHEN 0 THEN '2024-01-01T00:00:00' ELSE '2024-02-01T00:00:00' END AS synced_at
FROM part, (VALUES (0), (1)) AS c(v)
"""
TABLES["pending_orders"] = f"""
SELECT order_id, orderkey, order_type, isbn13, source_location_id, target_location_id, qty, urgency_level, status,
       rejection_stage, reject_reason, created_at,
       CASE WHEN status IN ('APPROVED', 'IN_TRANSIT', 'EXECUTED', 'AUTO_EXECUTED') OR rejection_stage = 'APPROVED'
            THEN created_at + INTERVAL 1 HOUR END AS approved_at,
       CASE WHEN status IN ('IN_TRANSIT', 'EXECUTED', 'AUTO_EXECUTED') AND orderkey % 41 <> 0
            THEN created_at + INTERVAL 2 HOUR END AS dispatched_at,
       CASE WHEN status IN ('EXECUTED', 'AUTO_EXECUTED') AND orderkey % 43 <> 0 THEN created_at + INTERVAL 3 HOUR END AS executed_at,
       CASE WHEN orderkey % 4 = 0 THEN '{{}}'
            ELSE '{{"reason":"demand_growth","expected_arrival_date":"' || strftime(created_at + INTERVAL 3 DAY, '%Y-%m-%d') || '"}}'
            END AS forecast_rationale
FROM (
  SELECT 'ord-' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS order_id, o_orderkey AS orderkey,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'PUBLISHER_ORDER' WHEN '2-HIGH' THEN 'WH_TRANSFER'
              WHEN '3-MEDIUM' THEN 'REBALANCE' ELSE 'WH_TO_STORE' END AS order_type,
         {ISBN.format('o_custkey')} AS isbn13, o_orderkey % 16 + 1 AS source_location_id,
         o_custkey % 16 + 1 AS target_location_id, 1 + o_custkey % 50 AS qty,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'URGENT' ELSE 'NORMAL' END AS urgency_level,
         CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'PENDING' WHEN o_orderstatus = 'P' THEN 'APPROVED'
              WHEN o_orderstatus = 'O' THEN 'IN_TRANSIT' WHEN o_orderkey % 3 = 0 THEN 'EXECUTED'
              WHEN o_orderkey % 3 = 1 THEN 'AUTO_EXECUTED' ELSE 'REJECTED' END AS status,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 2 THEN
              CASE WHEN o_orderkey % 2 = 0 THEN 'PENDING' WHEN o_orderkey % 5 = 0 THEN 'LOST' ELSE 'APPROVED' END END AS rejection_stage,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 2 THEN 'stock_short' END AS reject_reason,
         o_orderdate AS created_at
  FROM orders)
"""
TABLES["order_approvals"] = """
SELECT o.order_id, s.side AS approval_side, CASE WHEN o.status = 'REJECTED' THEN 'REJECTED' ELSE 'APPROVED' END AS decision,
       o.created_at + s.lag_hours * INTERVAL 1 HOUR AS decided_at
FROM pending_orders o
JOIN (VALUES ('SOURCE', true, 1), ('TARGET', true, 2), ('SINGLE', false, 1)) AS s(side, two_sided, lag_hours)
  ON s.two_sided = (o.order_type IN ('WH_TRANSFER', 'REBALANCE'))
WHERE o.status IN ('APPROVED', 'REJECTED', 'AUTO_EXECUTED') AND NOT (s.side = 'TARGET' AND o.orderkey % 7 = 0)
"""
TABLES["forecast_results"] = """
SELECT (SELECT max(sale_date) FROM sales_lines) - run AS prediction_date,
       (SELECT max(sale_date) FROM sales_lines) - run + step AS target_date, isbn13, store_id,
       CASE WHEN run = 1 AND partkey % 101 = 0 THEN NULL WHEN run = 1 AND partkey % 103 = 0 THEN -1.0
            ELSE demand + step * 0.25 END AS predicted_demand,
       CASE WHEN run = 1 AND partkey % 107 = 0 THEN demand * 2 + 9 ELSE (demand + step * 0.25) * 0.75 END AS confidence_low,
       (demand + step * 0.25) * 1.25 AS confidence_high, 'store-demand-v' || CAST(2 - run AS VARCHAR) || '-catalog-retrained-weekly' AS model_version
FROM (SELECT isbn13, partkey, store_id, CAST(sum(qty) % 40 / 4.0 AS DOUBLE) AS demand FROM sales_lines GROUP BY 1, 2, 3),
     (VALUES (0), (1)) AS r(run), (VALUES (1), (2), (3), (4), (5)) AS k(step)
"""

def features_sql(spine: str, books: str, sns: str, inventory: str) -> str:
    """Covariates per (isbn13, feature_date) row of ``spine``."""
    return f"""
SELECT p.feature_date, p.isbn13, c.is_holiday, c.holiday_name, c.season, c.day_of_week, c.is_weekend, c.month,
       c.event_nearby_days,
       coalesce((SELECT CAST(sum(n.mentions) AS BIGINT) FROM {sns} n WHERE n.isbn13 = p.isbn13 AND n.mention_date = p.feature_date - 1), 0) AS sns_mentions_1d,
       coalesce((SELECT CAST(sum(n.mentions) AS BIGINT) FROM {sns} n WHERE n.isbn13 = p.isbn13
                 AND n.mention_date >= p.feature_date - 7 AND n.mention_date < p.feature_date), 0) AS sns_mentions_7d,
       greatest(p.feature_date - b.pub_date, 0) AS book_age_days, b.is_bestseller_flag,
       coalesce(st.on_hand_total, 0) AS on_hand_total, p.feature_date - z.out_date AS days_since_last_stockout
FROM {spine} p
JOIN calendar c ON c.day = p.feature_date
LEFT JOIN {books} b ON b.isbn13 = p.isbn13
LEFT JOIN (SELECT isbn13, snapshot_date, CAST(sum(greatest(on_hand - reserved_qty, 0)) AS BIGINT) AS on_hand_total
           FROM {inventory} GROUP BY 1, 2) st ON st.isbn13 = p.isbn13 AND st.snapshot_date = p.feature_date
ASOF LEFT JOIN (SELECT DISTINCT isbn13, snapshot_date AS out_date FROM {inventory} WHERE on_hand = 0) z
  ON z.isbn13 = p.isbn13 AND p.feature_date >= z.out_date
"""


TABLES["sale_spine"] = "SELECT DISTINCT isbn13, sale_date AS feature_date FROM sales_lines"
TABLES["book_spine"] = "SELECT b.isbn13, d.day AS feature_date FROM books_static b, sales_days d"
TABLES["features"] = features_sql("sale_spine", "books_static", "sns_daily", "inventory_daily")
TABLES["book_features"] = features_sql("book_spine", "books_static", "sns_daily", "inventory_daily")
