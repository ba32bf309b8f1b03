"""Sources, sinks and ingestion (S1 to S19)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.catalog import fixtures as fx
from shelfcast.catalog.registry import query
from shelfcast.domain import EVENT_TYPES, HOLIDAYS, MART_TABLES, YEARLY_EVENTS, locations_static, store_location_map
from shelfcast.functions.columns import is_isbn13
from shelfcast.operators.calendar import expand_yearly_events, holiday_dates
from shelfcast.operators.cleanse import clean_pos
from shelfcast.operators.series import densify, trailing
from shelfcast.session import fresh_dir
from shelfcast.sources import load, raw, tables
from shelfcast.streaming import pos


def day_parts(at):
    return {"year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd")}


@query("raw_pos_scan", "SELECT * FROM pos_raw")
def raw_pos_scan(spark, sf):
    path = fresh_dir(spark, "pos-events")
    parts = day_parts(F.expr("try_cast(ts AS timestamp)"))
    fx.pos_raw(spark, sf).withColumns(parts).write.partitionBy(*parts).option("compression", "gzip").json(path)
    return raw.read_pos(spark, path)


@query(
    "raw_catalog_scan",
    """SELECT isbn13, title, publisher, CAST(category_id AS INTEGER) AS category_id, category_name, price, sales_point, synced_at
       FROM catalog_raw WHERE regexp_full_match(isbn13, '[0-9]{13}')""",
)
def raw_catalog_scan(spark, sf):
    path = fresh_dir(spark, "catalog")
    fx.catalog_raw(spark, sf).write.option("compression", "gzip").json(path)
    columns = {
        "isbn13": "string", "title": "string", "publisher": "string", "category_id": "int", "category_name": "string",
        "price": "bigint", "sales_point": "bigint", "synced_at": "string",
    }
    return raw.read_ndjson(spark, path, columns).filter(is_isbn13("isbn13"))


YEARLY_SQL = """
SELECT event_type || '-' || strftime(make_date(y, e_month, e_day), '%Y%m%d') AS event_id, event_type,
       make_date(y, e_month, e_day) AS start_date, make_date(y, e_month, e_day) + CAST(e_days - 1 AS INTEGER) AS end_date
FROM yearly_events, (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
"""


def yearly_events(spark, sf):
    years = fx.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return expand_yearly_events(years, YEARLY_EVENTS)


@query(
    "multi_source_union",
    f"""WITH y AS ({YEARLY_SQL})
    SELECT event_id, event_type, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, NULL AS title
    FROM y WHERE event_type <> 'author_signing'
    UNION ALL SELECT 'holiday-' || strftime(holiday_date, '%Y%m%d'), 'holiday', CAST(holiday_date AS VARCHAR),
           CAST(holiday_date AS VARCHAR), holiday_name FROM holidays""",
)
def multi_source_union(spark, sf):
    path = fresh_dir(spark, "events")
    made = yearly_events(spark, sf)
    for kind in ("book_fair", "publisher_promo"):  # the author_signing folder stays absent
        made.filter(F.col("event_type") == kind).drop("event_type").write.json(f"{path}/{kind}")
    days = holiday_dates(spark, fx.literal_bounds(spark, sf), HOLIDAYS)
    days.select(
        F.concat_ws("-", F.lit("holiday"), F.date_format("holiday_date", "yyyyMMdd")).alias("event_id"),
        F.col("holiday_date").alias("start_date"), F.col("holiday_date").alias("end_date"), F.col("holiday_name").alias("title"),
    ).write.json(f"{path}/holiday")
    return raw.read_typed_folders(spark, path, EVENT_TYPES, "event_id STRING, start_date STRING, end_date STRING, title STRING")


@query(
    "partitioned_overwrite",
    """SELECT tx_id, isbn13, CASE WHEN sale_date >= DATE '2024-01-20' THEN qty * 2 ELSE qty END AS qty, sale_date
       FROM pos_clean_rows""",
)
def partitioned_overwrite(spark, sf):
    path = fresh_dir(spark, "pos-mart")
    rows = clean_pos(fx.pos_raw(spark, sf)).select("tx_id", "isbn13", "qty", "sale_date")
    tables.overwrite_partitions(rows, path, "sale_date", files_per_partition=4)
    late = rows.filter("sale_date >= DATE '2024-01-20'").withColumn("qty", F.col("qty") * 2)
    tables.overwrite_partitions(late, path, "sale_date", files_per_partition=4)
    return spark.read.parquet(path)


BOOK_TARGET = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("title_as_number", T.LongType()),
        T.StructField("list_price", T.DoubleType()),
        T.StructField("tax_rate", T.DoubleType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("pub_date", T.DateType()),
    ]
)


@query(
    "schema_align_load",
    """SELECT p_partkey, p_name AS title, CAST(p_size AS INTEGER) AS category_id, TRY_CAST(p_name AS BIGINT) AS title_as_number,
              p_retailprice AS list_price, CAST(0.1 AS DOUBLE) AS tax_rate, CAST(NULL AS DOUBLE) AS rating,
              TRY_CAST(p_brand AS DATE) AS pub_date FROM part""",
)
def schema_align_load(spark, sf):
    aliases = {
        "title": "p_name", "category_id": "p_size", "title_as_number": "p_name", "list_price": "p_retailprice",
        "tax_rate": "0.1", "rating": "no_such_column", "pub_date": "p_brand",
    }
    return load.align(fx.table(spark, sf, "part"), BOOK_TARGET, aliases)


PATHS_SQL = """
SELECT CASE o_orderkey % 9
    WHEN 0 THEN 'mart/pos_events/sale_date=' || strftime(o_orderdate, '%Y-%m-%d') || '/part-' || o_orderkey || '.parquet'
    WHEN 1 THEN 'mart/aladin_books/part-' || o_orderkey || '.parquet'
    WHEN 2 THEN 'mart/features/.spark-staging-' || o_orderkey || '/feature_date=2026-05-19/part-1.parquet'
    WHEN 3 THEN 'mart/features/_temporary/0/' || o_orderkey || '/part-1.parquet'
    WHEN 4 THEN 'functions/load-' || o_orderkey || '.zip'
    WHEN 5 THEN 'pipelines/books-' || o_orderkey || '.json'
    WHEN 6 THEN 'landing/calendar_events/event_type=holiday/' || o_orderkey || '.parquet'
    WHEN 7 THEN 'mart/unknown_' || o_orderkey || '/part-1.parquet'
    ELSE 'sns_mentions/mention_date=' || strftime(o_orderdate, '%Y-%m-%d') || '/' || o_orderkey || '.parquet' END AS path
FROM orders
"""
MAP_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MART_TABLES.items())
ROUTE_SQL = f"""
SELECT path, folder, base_prefix, CASE folder {MAP_SQL} END AS target_table, regexp_matches(path, '/[^/]+=') AS is_partitioned,
       is_internal, path LIKE 'mart/%' AND path LIKE '%.parquet' AND NOT is_internal AS is_loadable
FROM (SELECT path, CASE WHEN path LIKE 'mart/%' THEN split_part(path, '/', 2) ELSE split_part(path, '/', 1) END AS folder,
        CASE WHEN path LIKE 'mart/%' THEN 'mart/' || split_part(path, '/', 2)
             WHEN regexp_matches(path, '/[^/]+=') THEN regexp_extract(path, '^(.*?)/[^/]+=', 1) ELSE split_part(path, '/', 1) END AS base_prefix,
        regexp_matches(path, '^functions/|^pipelines/|\\.zip$|\\.json$|\\.spark-staging-|/_temporary/') AS is_internal
      FROM ({PATHS_SQL}))
"""


def object_paths(spark, sf):
    key, day = F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd")
    forms = [
        ("mart/pos_events/sale_date=", day, "/part-", key, ".parquet"),
        ("mart/aladin_books/part-", key, ".parquet"),
        ("mart/features/.spark-staging-", key, "/feature_date=2026-05-19/part-1.parquet"),
        ("mart/features/_temporary/0/", key, "/part-1.parquet"),
        ("functions/load-", key, ".zip"),
        ("pipelines/books-", key, ".json"),
        ("landing/calendar_events/event_type=holiday/", key, ".parquet"),
        ("mart/unknown_", key, "/part-1.parquet"),
        ("sns_mentions/mention_date=", day, "/", key, ".parquet"),
    ]
    text = F.array(*[F.concat(*[F.lit(p) if isinstance(p, str) else p for p in form]) for form in forms])
    return fx.table(spark, sf, "orders").select(F.element_at(text, (F.col("o_orderkey") % 9 + 1).cast("int")).alias("path"))


@query("path_route", ROUTE_SQL)
def path_route(spark, sf):
    return load.route_paths(object_paths(spark, sf))


@query("artifact_filter", f"SELECT path, target_table FROM ({ROUTE_SQL}) WHERE is_loadable")
def artifact_filter(spark, sf):
    return load.route_paths(object_paths(spark, sf)).filter("is_loadable").select("path", "target_table")


@query(
    "hive_partition_scan",
    """SELECT mention_id, isbn13, mention_count, collected_at FROM sns_raw
       WHERE date_trunc('hour', CAST(collected_at AS TIMESTAMP)) >=
             (SELECT date_trunc('hour', max(CAST(collected_at AS TIMESTAMP))) - INTERVAL 1 HOUR FROM sns_raw)""",
)
def hive_partition_scan(spark, sf):
    path = fresh_dir(spark, "sns")
    rows = fx.sns_raw(spark, sf).select("mention_id", "isbn13", "mention_count", "collected_at")
    at = F.col("collected_at").cast("timestamp")
    parts = {**day_parts(at), "hour": F.date_format(at, "HH")}
    rows.withColumns(parts).write.partitionBy(*parts).json(path)
    now = rows.agg(F.max(at)).first()[0]
    columns = "mention_id STRING, isbn13 STRING, mention_count STRING, collected_at STRING"
    return raw.read_recent_hours(spark, path, now, f"{columns}, year INT, month INT, day INT, hour INT").drop(*parts)


@query(
    "jdbc_mart_export",
    """SELECT 'inventory' AS table_name, count(*) AS row_count, CAST(sum(location_id) AS BIGINT) AS key_sum FROM inventory
       UNION ALL SELECT 'locations_static', count(*), CAST(sum(location_id) AS BIGINT) FROM locations_static
       UNION ALL SELECT 'store_location_map', count(*), CAST(sum(location_id) AS BIGINT) FROM store_location_map""",
)
def jdbc_mart_export(spark, sf):
    base = fresh_dir(spark, "export")
    stand_ins = {
        "inventory": fx.inventory(spark, sf),
        "locations_static": locations_static(spark),
        "store_location_map": store_location_map(spark),
    }
    out = None
    for name, path in raw.export_tables(stand_ins, base).items():
        part = spark.read.parquet(path).agg(F.count("*").alias("row_count"), F.sum("location_id").alias("key_sum"))
        part = part.select(F.lit(name).alias("table_name"), "row_count", "key_sum")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "csv_roundtrip",
    """SELECT isbn13, title, category_id, author, pub_date, price_sales, is_bestseller_flag, CAST(NULL AS DOUBLE) AS rating
       FROM books_static""",
)
def csv_roundtrip(spark, sf):
    path = fresh_dir(spark, "csv")
    fx.books_static(spark, sf).drop("partkey").write.option("header", "true").csv(path)
    target = T.StructType(
        [
            T.StructField("isbn13", T.StringType()), T.StructField("title", T.StringType()), T.StructField("category_id", T.LongType()),
            T.StructField("author", T.StringType()), T.StructField("pub_date", T.DateType()), T.StructField("price_sales", T.LongType()),
            T.StructField("is_bestseller_flag", T.BooleanType()), T.StructField("rating", T.DoubleType()),
        ]
    )
    return load.align(raw.read_csv(spark, path), target)


@query(
    "insert_ignore",
    """WITH incoming AS (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY ts, isbn13, qty) AS rn FROM pos_raw),
            kept AS (SELECT * FROM pos_clean_rows WHERE sale_date < DATE '2024-01-11')
       SELECT tx_id, isbn13, qty, location_id FROM kept
       UNION ALL SELECT tx_id, isbn13, qty, location_id FROM incoming WHERE rn = 1 AND tx_id NOT IN (SELECT tx_id FROM kept)""",
)
def insert_ignore(spark, sf):
    columns = ["tx_id", "isbn13", "qty", "location_id"]
    kept = clean_pos(fx.pos_raw(spark, sf)).filter("sale_date < DATE '2024-01-11'").select(*columns)
    incoming = fx.pos_raw(spark, sf).select(*columns, "ts")
    return kept.unionByName(tables.new_rows(kept, incoming, ["tx_id"], ["ts", "isbn13", "qty"]).select(*columns))


@query(
    "upsert",
    """WITH cached AS (SELECT * FROM forecast_results WHERE prediction_date < (SELECT max(prediction_date) FROM forecast_results)),
            fresh AS (SELECT * FROM forecast_results WHERE prediction_date = (SELECT max(prediction_date) FROM forecast_results))
       SELECT target_date, isbn13, store_id, predicted_demand, model_version FROM fresh
       UNION ALL SELECT target_date, isbn13, store_id, predicted_demand, model_version FROM cached c
       WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.target_date = c.target_date AND f.isbn13 = c.isbn13 AND f.store_id = c.store_id)""",
)
def upsert(spark, sf):
    runs = fx.forecast_results(spark, sf)
    newest = fx.newest_sale(spark, sf)
    columns = ["target_date", "isbn13", "store_id", "predicted_demand", "model_version"]
    cached = runs.filter(F.col("prediction_date") < newest).select(*columns)
    fresh = runs.filter(F.col("prediction_date") == newest).select(*columns)
    return tables.upsert(cached, fresh, ["target_date", "isbn13", "store_id"])


@query(
    "replace_partition",
    """SELECT prediction_date, target_date, isbn13, store_id,
              CASE WHEN prediction_date = (SELECT max(sale_date) FROM sales_lines) THEN predicted_demand * 2 ELSE predicted_demand END AS predicted_demand
       FROM forecast_results""",
)
def replace_partition(spark, sf):
    path = fresh_dir(spark, "forecast")
    rows = fx.forecast_results(spark, sf).select("prediction_date", "target_date", "isbn13", "store_id", "predicted_demand")
    rows = rows.withColumn("predicted_demand", F.col("predicted_demand").cast("decimal(38,9)"))
    tables.overwrite_partitions(rows, path, "prediction_date")
    newest = fx.sale_days(spark, sf)[1]
    promoted = rows.withColumn("predicted_demand", (F.col("predicted_demand") * 2).cast("decimal(38,9)"))
    tables.replace_partition(promoted, path, "prediction_date", newest)
    return spark.read.parquet(path).withColumn("predicted_demand", F.col("predicted_demand").cast("double"))


def store_days(spark, sf):
    sold = fx.sales_lines(spark, sf).groupBy("store_id", "sale_date").agg(F.sum("qty").alias("qty"))
    return densify(sold, ["store_id"], "sale_date", ["qty"], *fx.sale_period(spark, sf))


def with_month_mean(df):
    mean = F.avg("qty").over(trailing(["store_id"], "sale_date", 28))
    return df.select("store_id", "sale_date", "qty", F.round(mean, 4).alias("mean_28"), F.trunc("sale_date", "month").alias("sale_month"))


@query(
    "range_replace",
    """WITH d AS (SELECT k.store_id, x.day AS sale_date, coalesce(s.qty, 0) AS qty FROM (SELECT DISTINCT store_id FROM sales_lines) k CROSS JOIN sales_days x
                  LEFT JOIN (SELECT store_id, sale_date, CAST(sum(qty) AS BIGINT) AS qty FROM sales_lines GROUP BY 1, 2) s
                    ON s.store_id = k.store_id AND s.sale_date = x.day),
            c AS (SELECT store_id, sale_date, CASE WHEN sale_date >= DATE '2001-10-01' THEN qty * 2 ELSE qty END AS qty FROM d)
       SELECT store_id, sale_date, qty, round(avg(qty) OVER (PARTITION BY store_id ORDER BY sale_date
              ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 4) AS mean_28, CAST(date_trunc('month', sale_date) AS DATE) AS sale_month FROM c""",
)
def range_replace(spark, sf):
    path = fresh_dir(spark, "store-days")
    start, end = F.lit("2001-10-01").cast("date"), F.lit("2001-12-31").cast("date")
    days = store_days(spark, sf)
    tables.overwrite_partitions(with_month_mean(days), path, "sale_month", files_per_partition=4)
    doubled = days.withColumn("qty", F.when(F.col("sale_date") >= start, F.col("qty") * 2).otherwise(F.col("qty")))
    # The series is dense, so 28 days of lead-in are the 28 rows the mean needs.
    redone = with_month_mean(doubled.filter(F.col("sale_date") >= F.date_sub(start, 28)))
    tables.replace_range(redone, path, "sale_month", start, end)
    return spark.read.parquet(path)


@query("snapshot_clone_swap", "SELECT isbn13, title, price_sales + 500 AS price_sales FROM books_static")
def snapshot_clone_swap(spark, sf):
    base = fresh_dir(spark, "books")
    books = fx.books_static(spark, sf).select("isbn13", "title", "price_sales")
    tables.publish_version(spark, books, base)
    size = books.count()
    raised = books.withColumn("price_sales", F.col("price_sales") + 500)
    tables.publish_version(spark, raised, base, check=lambda df: df.count() == size)
    return tables.read_current(spark, base)


@query(
    "feature_serving_export",
    """SELECT to_json({'isbn13': isbn13, 'feature_date': CAST(feature_date AS VARCHAR), 'day_of_week': day_of_week, 'is_holiday': is_holiday,
                       'sns_mentions_7d': sns_mentions_7d})::VARCHAR AS instance
       FROM features ORDER BY feature_date DESC, isbn13 LIMIT 100""",
)
def feature_serving_export(spark, sf):
    rows = fx.features(spark, sf)
    columns = ["isbn13", "feature_date", "day_of_week", "is_holiday", "sns_mentions_7d"]
    return tables.serving_rows(rows, columns, [F.desc("feature_date"), "isbn13"], 100)


EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def event_stream(spark, sf):
    return pos.read_stream(spark, f"{str(sf).rstrip('/')}/events.parquet", T.StructType.fromDDL(EVENT_SCHEMA), "parquet")


@query("stream_pos_source", "SELECT * FROM pos_raw")
def stream_pos_source(spark, sf):
    path = fresh_dir(spark, "pos-stream")
    stream = fx.pos_events(event_stream(spark, sf)).writeStream.format("parquet").option("path", f"{path}/rows")
    stream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows")


@query(
    "stream_archive_sink",
    """SELECT CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day, count(*) AS lines
       FROM (SELECT TRY_CAST(ts AS TIMESTAMP) AS t FROM pos_raw) GROUP BY 1, 2, 3""",
)
def stream_archive_sink(spark, sf):
    path = fresh_dir(spark, "archive")
    rows = fx.pos_events(event_stream(spark, sf))
    lines = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    at = F.expr("try_cast(get_json_object(value, '$.ts') AS timestamp)")
    pos.archive(lines, path, f"{path}/checkpoint", at).awaitTermination()
    good = spark.read.text(f"{path}/data").groupBy("year", "month", "day").agg(F.count("*").alias("lines"))
    bad = spark.read.text(f"{path}/errors").agg(F.count("*").alias("lines")).filter("lines > 0")
    none = F.lit(None).cast("int")
    return good.select("year", "month", "day", "lines").unionByName(bad.select(none.alias("year"), none.alias("month"), none.alias("day"), "lines"))


@query(
    "dim_values",
    """SELECT l.location_id, l.name, l.size, m.inventory_location_id, m.mapping_rule, CAST(sum(s.qty) AS BIGINT) AS qty
       FROM sales_lines s JOIN store_location_map m ON m.store_id = s.store_id JOIN locations_static l ON l.location_id = m.location_id
       GROUP BY 1, 2, 3, 4, 5""",
)
def dim_values(spark, sf):
    sold = fx.sales_lines(spark, sf).groupBy("store_id").agg(F.sum("qty").alias("qty"))
    placed = sold.join(store_location_map(spark), "store_id").join(locations_static(spark), "location_id")
    return placed.select("location_id", "name", "size", "inventory_location_id", "mapping_rule", "qty")

