"""Streaming operators (T-1 to T-9), run over everything that is available."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.catalog import fixtures as fx
from shelfcast.catalog.join_queries import baselines
from shelfcast.catalog.reference_sql import ISBN, TABLES
from shelfcast.catalog.registry import query
from shelfcast.catalog.rollup_queries import DAILY_SQL, daily
from shelfcast.catalog.source_queries import event_stream
from shelfcast.domain import locations_static
from shelfcast.operators import enrich, rollups
from shelfcast.operators.cleanse import clean_sns
from shelfcast.session import fresh_dir
from shelfcast.streaming import pos, spikes

TABLES["pos_stored"] = """
SELECT tx_id AS txn_id, t AS event_ts, CAST(p.location_id AS BIGINT) AS store_id, CAST(CASE WHEN p.location_id BETWEEN 6 AND 10 THEN 2 ELSE 1 END AS BIGINT) AS wh_id, channel, isbn13, CAST(qty AS BIGINT) AS qty, unit_price,
       CAST(0 AS BIGINT) AS discount, total_price AS revenue, CAST(NULL AS VARCHAR) AS payment_method, CAST(t + INTERVAL 9 HOUR AS DATE) AS kpi_date,
       CAST(CASE WHEN p.location_id = 13 THEN 15 WHEN p.location_id = 14 THEN 16 ELSE p.location_id END AS BIGINT) AS debit_location_id
FROM (SELECT *, CAST(ts AS TIMESTAMP) AS t, row_number() OVER (PARTITION BY tx_id ORDER BY qty) AS rn FROM pos_raw WHERE ts <> 'not-a-time') p WHERE rn = 1
"""


def ingested(spark, sf) -> pos.PosTables:
    """Run the ingest stream over the purchase events, delivered as files of JSON lines.

    Copies of a transaction share a file, so it does not matter which file comes first.
    """
    base = fresh_dir(spark, "pos")
    rows = fx.pos_raw(spark, sf)
    lines = rows.select("tx_id", F.to_json(F.struct(*rows.columns)).alias("value"))
    lines.repartition(4, "tx_id").select("value").write.text(f"{base}/landing")
    stream = pos.read_stream(spark, f"{base}/landing", T.StructType.fromDDL("value STRING"), "text", files=2)
    tables = pos.PosTables(spark, f"{base}/tables")
    pos.run_ingest(stream, tables, locations_static(spark), fx.inventory(spark, sf)).awaitTermination()
    return tables


def stored_sales(spark, sf):
    return ingested(spark, sf).get("sales", pos.SALES_COLUMNS)


@query("stream_pos_ingest", "SELECT * FROM pos_stored")
def stream_pos_ingest(spark, sf):
    return stored_sales(spark, sf)


@query(
    "stream_kpi",
    """SELECT a.*, t.isbn13 AS top_isbn FROM (
         SELECT kpi_date, store_id, channel, CAST(sum(qty) AS BIGINT) AS qty_sold, CAST(sum(revenue) AS BIGINT) AS revenue, count(*) AS tx_count,
                count(DISTINCT isbn13) AS unique_isbn_count, CAST(sum(revenue) // nullif(sum(qty), 0) AS BIGINT) AS avg_price FROM pos_stored GROUP BY 1, 2, 3) a
       JOIN (SELECT kpi_date, store_id, channel, isbn13, row_number() OVER (PARTITION BY kpi_date, store_id, channel ORDER BY sum(qty) DESC, isbn13) AS rn
             FROM pos_stored GROUP BY 1, 2, 3, 4) t ON t.kpi_date = a.kpi_date AND t.store_id = a.store_id AND t.channel = a.channel AND t.rn = 1""",
)
def stream_kpi(spark, sf):
    return pos.newest(ingested(spark, sf), "kpi", pos.KPI_COLUMNS, pos.KPI_KEYS)


@query(
    "stream_inventory",
    """SELECT i.isbn13, i.location_id, greatest(i.on_hand - coalesce(s.taken, 0), 0) AS on_hand, i.reserved_qty, i.safety_stock, s.taken FROM inventory i
       LEFT JOIN (SELECT isbn13, debit_location_id, CAST(sum(qty) AS BIGINT) AS taken FROM pos_stored GROUP BY 1, 2) s
         ON s.isbn13 = i.isbn13 AND s.debit_location_id = i.location_id""",
)
def stream_inventory(spark, sf):
    return pos.stock_now(ingested(spark, sf), fx.inventory(spark, sf))


@query("stream_bad_records", "SELECT tx_id, 'bad_ts' AS reason, count(*) AS lines FROM pos_raw WHERE ts = 'not-a-time' GROUP BY 1")
def stream_bad_records(spark, sf):
    bad = ingested(spark, sf).get("rejected", "line STRING, reason STRING")
    return bad.groupBy(F.get_json_object("line", "$.tx_id").alias("tx_id"), "reason").agg(F.count("*").alias("lines"))


@query(
    "stream_stock_changed",
    """SELECT i.isbn13, i.location_id, greatest(i.on_hand - s.taken, 0) - i.reserved_qty AS available, 'stock:' || i.isbn13 || ':' || i.location_id AS cache_key FROM inventory i
       JOIN (SELECT isbn13, debit_location_id, CAST(sum(qty) AS BIGINT) AS taken FROM pos_stored GROUP BY 1, 2) s
         ON s.isbn13 = i.isbn13 AND s.debit_location_id = i.location_id""",
)
def stream_stock_changed(spark, sf):
    return pos.newest(ingested(spark, sf), "stock_changed", pos.EVENT_COLUMNS, ["isbn13", "location_id"])


@query(
    "audit_log_sink",
    """SELECT 'pos-stream' AS actor_id, 'sales.ingest' AS action, 'sales_realtime' AS entity_type, txn_id AS entity_id,
              to_json({'isbn13': isbn13, 'store_id': store_id, 'qty': qty})::VARCHAR AS after_state FROM pos_stored""",
)
def audit_log_sink(spark, sf):
    return ingested(spark, sf).get("audit", "actor_id STRING, action STRING, entity_type STRING, entity_id STRING, after_state STRING")


@query("stream_dedupe", "SELECT DISTINCT tx_id FROM pos_raw WHERE ts <> 'not-a-time'")
def stream_dedupe(spark, sf):
    path = fresh_dir(spark, "dedupe")
    rows = fx.pos_events(event_stream(spark, sf)).withColumn("event_ts", F.expr("try_cast(ts AS timestamp)")).filter("event_ts IS NOT NULL")
    writer = pos.dedupe_stream(rows).select("tx_id").writeStream.format("parquet").option("path", f"{path}/rows")
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows")


@query(
    "stream_kpi_windows",
    """WITH r AS (SELECT *, CAST(ts AS TIMESTAMP) AS t FROM pos_raw WHERE ts <> 'not-a-time')
       SELECT CAST(t + INTERVAL 9 HOUR AS DATE) AS kpi_date, CAST(location_id AS BIGINT) AS store_id, channel, CAST(sum(qty) AS BIGINT) AS qty_sold, CAST(sum(total_price) AS BIGINT) AS revenue,
              count(*) AS tx_count FROM r GROUP BY 1, 2, 3 HAVING CAST(t + INTERVAL 9 HOUR AS DATE) + INTERVAL 15 HOUR <= (SELECT max(t) FROM r) - INTERVAL 1 DAY""",
)
def stream_kpi_windows(spark, sf):
    path = fresh_dir(spark, "kpi-windows")
    rows = fx.pos_events(event_stream(spark, sf)).select(
        F.expr("try_cast(ts AS timestamp)").alias("event_ts"), F.col("location_id").cast("bigint").alias("store_id"), "channel",
        F.col("qty").cast("bigint").alias("qty"), F.col("total_price").alias("revenue"),
    ).filter("event_ts IS NOT NULL")
    writer = pos.kpi_stream(rows).writeStream.outputMode("append").format("parquet").option("path", f"{path}/rows")
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows")


@query(
    "spike_poisson",
    """WITH m AS (SELECT isbn13, date_trunc('hour', collected_at) AS h FROM sns_mentions),
            c AS (SELECT isbn13, count(*) AS n FROM m WHERE h >= (SELECT max(h) FROM m) - INTERVAL 1 HOUR GROUP BY 1),
            z AS (SELECT b.isbn13, coalesce(c.n, 0) AS mentions_count, (coalesce(c.n, 0) - lam) / sqrt(lam) AS z FROM (
                    SELECT isbn13, CASE WHEN partkey % 3 = 0 THEN 5.0 ELSE (1 + partkey % 20) / 20.0 END AS lam FROM books_static) b LEFT JOIN c ON c.isbn13 = b.isbn13)
       SELECT isbn13, round(z, 2) AS z_score, mentions_count, CAST(least(400, greatest(30, round_even(round(z, 2) * 30, 0))) AS INTEGER) AS predicted_qty
       FROM z WHERE z >= 0.5""",
)
def spike_poisson(spark, sf):
    mentions = clean_sns(fx.sns_raw(spark, sf)).withColumn("h", F.date_trunc("hour", "collected_at"))
    newest = mentions.agg(F.max("h").alias("h")).scalar()
    recent = mentions.filter(F.col("h") >= newest - F.expr("INTERVAL 1 HOUR")).groupBy("isbn13").agg(F.count("*").alias("mentions_count"))
    base = baselines(spark, sf).withColumn("baseline_lam", F.col("baseline_lam") / 20)
    return rollups.poisson_spikes(enrich.tracked_counts(base, recent), threshold=0.5)


@query(
    "stream_spike_poisson",
    f"""WITH m AS (SELECT {ISBN.format('user_id')} AS isbn13, ts FROM events WHERE event_type IN ('view', 'click')),
            w AS (SELECT isbn13, date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS s FROM m, (VALUES (0), (1)) AS o(k)),
            c AS (SELECT s AS window_start, s + INTERVAL 2 HOUR AS window_end, isbn13, count(*) AS mentions_count FROM w GROUP BY 1, 2, 3)
        SELECT *, round((mentions_count - 1) / 1.0, 2) AS z_score, CAST(least(400, greatest(30, (mentions_count - 1) * 30)) AS INTEGER) AS predicted_qty
        FROM c WHERE mentions_count - 1 >= 1 AND window_end <= (SELECT max(ts) FROM m) - INTERVAL 1 HOUR""",
)
def stream_spike_poisson(spark, sf):
    path = fresh_dir(spark, "mentions")
    mentions = event_stream(spark, sf).filter(F.col("event_type").isin("view", "click")).select(fx.isbn("user_id").alias("isbn13"), F.col("ts").alias("collected_at"))
    counts = spikes.poisson_score(spikes.mention_windows(mentions), default_baseline=1.0, threshold=1.0)
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", f"{path}/rows")
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def purchases(events):
    return events.filter("event_type = 'purchase'").select(fx.isbn("user_id").alias("isbn13"), F.col("ts").cast("timestamp").alias("event_ts"))


@query(
    "spike_window_zscores",
    f"""WITH m AS (SELECT {ISBN.format('user_id')} AS isbn13, ts FROM events WHERE event_type = 'purchase'),
            w AS (SELECT isbn13, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') - k * INTERVAL 6 HOUR AS s FROM m, (VALUES (0), (1)) AS o(k)),
            c AS (SELECT s AS window_start, s + INTERVAL 12 HOUR AS window_end, isbn13, count(*) AS count_w FROM w GROUP BY 1, 2, 3),
            t AS (SELECT window_start, avg(count_w) AS mean_w, stddev_pop(count_w) AS std_w FROM c GROUP BY 1)
        SELECT c.window_start, c.window_end, c.isbn13, c.count_w, round(t.mean_w, 4) AS mean_w, round(t.std_w, 4) AS std_w, round((c.count_w - t.mean_w) / t.std_w, 4) AS z_score
        FROM c JOIN t ON t.window_start = c.window_start WHERE t.std_w > 0 AND (c.count_w - t.mean_w) / t.std_w >= 2.05""",
)
def spike_window_zscores(spark, sf):
    counts = spikes.sales_windows(purchases(fx.table(spark, sf, "events")), width="12 hours", slide="6 hours")
    found = spikes.window_zscores(counts, threshold=2.05)
    return found.withColumns({c: F.round(c, 4) for c in ("mean_w", "std_w", "z_score")})


@query("stream_spike_zscore")
def stream_spike_zscore(spark, sf):
    tables = pos.PosTables(spark, fresh_dir(spark, "spikes"))
    spikes.run_spikes(purchases(event_stream(spark, sf)), tables, width="12 hours", slide="10 minutes", delay="1 hour").awaitTermination()
    return tables.get("spikes", spikes.SPIKE_COLUMNS)


@query("mart_file_mirror", DAILY_SQL)
def mart_file_mirror(spark, sf):
    base = fresh_dir(spark, "mirror")
    rows = daily(spark, sf)
    rows.write.parquet(f"{base}/mart/sales_daily")
    pos.mirror(spark, f"{base}/mart/sales_daily", f"{base}/copy/sales_daily", rows.schema, f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/copy/sales_daily")
