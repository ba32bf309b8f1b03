"""Projections, filters, cleansing (P1 to P23) and scalar function families."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import fixtures as fx
from shelfcast.catalog.reference_sql import ISBN
from shelfcast.catalog.registry import query
from shelfcast.catalog.source_queries import YEARLY_SQL, yearly_events
from shelfcast.domain import HOLIDAYS, LOCATION_REMAP, STORE_REMAP, STORE_REMAP_WH, store_location_map
from shelfcast.functions import columns as fn
from shelfcast.operators import calendar as cal
from shelfcast.operators import cleanse, enrich, rollups
from shelfcast.operators.keyed import sorted_bijection


@query("pos_clean", "SELECT * FROM pos_clean_rows")
def pos_clean(spark, sf):
    return cleanse.clean_pos(fx.pos_raw(spark, sf))


@query("isbn_regex_filter", "SELECT mention_id, isbn13 FROM sns_raw WHERE regexp_full_match(isbn13, '[0-9]{13}')")
def isbn_regex_filter(spark, sf):
    return fx.sns_raw(spark, sf).select("mention_id", "isbn13").filter(fn.is_isbn13("isbn13"))


CHECK_SQL = "(10 - (" + " + ".join(f"CAST(substr(isbn13, {i + 1}, 1) AS INTEGER) * {1 if i % 2 == 0 else 3}" for i in range(12)) + ") % 10) % 10"


@query(
    "isbn13_checksum",
    f"""SELECT isbn13, CAST({CHECK_SQL} AS INTEGER) AS check_digit,
               {CHECK_SQL} = CAST(substr(isbn13, 13, 1) AS INTEGER) AS is_valid FROM books_static""",
)
def isbn13_checksum(spark, sf):
    books = fx.books_static(spark, sf)
    return books.select("isbn13", fn.isbn13_check_digit("isbn13").alias("check_digit"), fn.isbn13_checksum_ok("isbn13").alias("is_valid"))


@query(
    "catalog_latest",
    """SELECT isbn13, title, publisher, CAST(category_id AS INTEGER) AS category_id, category_name, price, sales_point, synced_at
       FROM (SELECT *, row_number() OVER (PARTITION BY isbn13 ORDER BY synced_at DESC) AS rn FROM catalog_raw
             WHERE regexp_full_match(isbn13, '[0-9]{13}')) WHERE rn = 1""",
)
def catalog_latest(spark, sf):
    return cleanse.clean_catalog(fx.catalog_raw(spark, sf))


@query(
    "event_clean",
    f"""WITH y AS ({YEARLY_SQL}) SELECT event_id, event_type, start_date, end_date, 'hall of ' || event_type AS event_location FROM y""",
)
def event_clean(spark, sf):
    made = yearly_events(spark, sf).withColumn("location", F.concat(F.lit("hall of "), "event_type"))
    later = made.withColumn("start_date", F.date_add("start_date", 1))
    return cleanse.clean_events(made.unionByName(later))


@query("sns_clean", "SELECT * FROM sns_mentions")
def sns_clean(spark, sf):
    return cleanse.clean_sns(fx.sns_raw(spark, sf))


@query(
    "pos_normalize",
    f"""SELECT CAST(event_id AS VARCHAR) AS txn_id,
        CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE date_trunc('second', ts) END AS event_ts,
        user_id % 14 + 1 AS store_id, CASE WHEN event_id % 2 = 0 THEN 1 ELSE user_id % 2 + 1 END AS wh_id,
        CASE WHEN event_id % 5 = 0 THEN 'OFFLINE' ELSE 'online' END AS channel, {ISBN.format('user_id')} AS isbn13, event_id % 6 AS qty,
        CASE WHEN event_id % 4 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS unit_price, CAST(0 AS BIGINT) AS discount,
        CASE WHEN event_id % 3 <> 0 THEN event_id % 6 * CAST(floor(value * 90) AS BIGINT)
             ELSE event_id % 6 * CASE WHEN event_id % 4 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END END AS revenue,
        CAST(NULL AS VARCHAR) AS payment_method FROM events WHERE event_type = 'purchase'""",
)
def pos_normalize(spark, sf):
    key, price = F.col("event_id"), F.floor(F.col("value") * 100)
    records = fx.table(spark, sf, "events").filter("event_type = 'purchase'").select(
        key.cast("string").alias("tx_id"),
        F.when(key % 7 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        (F.col("user_id") % 14 + 1).alias("location_id"),
        F.when(key % 2 != 0, F.col("user_id") % 2 + 1).alias("wh_id"),
        F.when(key % 5 != 0, "online").alias("channel"),
        fx.isbn("user_id").alias("isbn13"),
        (key % 6).alias("qty"),
        F.when(key % 4 != 0, price).alias("unit_price"),
        F.when(key % 3 != 0, key % 6 * F.floor(F.col("value") * 90)).alias("total_price"),
    )
    return cleanse.normalize_pos(records, now=F.lit("2024-02-01 00:00:00").cast("timestamp"))


@query(
    "store_wh_lookup",
    """SELECT txn_id, store_id, CAST(CASE WHEN store_id BETWEEN 6 AND 10 THEN 2 ELSE 1 END AS BIGINT) AS wh_id,
              channel || '-channel' AS channel, count(*) AS lines FROM sales_lines GROUP BY 1, 2, 3, 4""",
)
def store_wh_lookup(spark, sf):
    lines = fx.sales_lines(spark, sf).select("txn_id", "store_id", F.concat("channel", F.lit("-channel")).alias("channel"))
    return lines.withColumns(cleanse.stream_warehouse()).groupBy("txn_id", "store_id", "wh_id", "channel").agg(F.count("*").alias("lines"))


@query(
    "price_tier",
    """SELECT isbn13, price_standard, CASE WHEN price_standard < 10000 THEN 'LOW' WHEN price_standard < 20000 THEN 'MID' ELSE 'HIGH' END AS tier_a,
              CASE WHEN price_standard < 15000 THEN 'LOW' WHEN price_standard < 26000 THEN 'MID' ELSE 'HIGH' END AS tier_b FROM books_static""",
)
def price_tier(spark, sf):
    books = fx.books_static(spark, sf)
    return books.select(
        "isbn13", "price_standard", fn.price_tier("price_standard").alias("tier_a"),
        fn.price_tier("price_standard", 15_000, 26_000).alias("tier_b"),
    )


@query(
    "season",
    """SELECT CASE WHEN month(sale_date) IN (3, 4, 5) THEN 'SPRING' WHEN month(sale_date) IN (6, 7, 8) THEN 'SUMMER'
                   WHEN month(sale_date) IN (9, 10, 11) THEN 'FALL' ELSE 'WINTER' END AS season,
              CAST(sum(qty) AS BIGINT) AS qty, count(*) AS lines FROM sales_lines GROUP BY 1""",
)
def season(spark, sf):
    lines = fx.sales_lines(spark, sf)
    return lines.groupBy(fn.season(F.month("sale_date")).alias("season")).agg(F.sum("qty").alias("qty"), F.count("*").alias("lines"))


@query(
    "author_dim",
    """SELECT 'author' AS kind, name, md5(name) AS id, CAST(max(n) AS BIGINT) AS past_books_count FROM (
         SELECT CASE WHEN trim(split_part(trim(split_part(coalesce(author, ''), ',', 1)), ';', 1)) = '' THEN '(unknown)'
                     ELSE trim(split_part(trim(split_part(coalesce(author, ''), ',', 1)), ';', 1)) END AS name,
                author_past_books_count AS n FROM books_static) GROUP BY 2
       UNION ALL SELECT DISTINCT 'publisher', publisher, md5(publisher), CAST(NULL AS BIGINT) FROM books_static""",
)
def author_dim(spark, sf):
    books = fx.books_static(spark, sf)
    authors = cleanse.author_table(books).select(F.lit("author").alias("kind"), "name", F.col("author_id").alias("id"), "past_books_count")
    houses = cleanse.publisher_table(books).select(
        F.lit("publisher").alias("kind"), "name", F.col("publisher_id").alias("id"), F.lit(None).cast("bigint").alias("past_books_count")
    )
    return authors.unionByName(houses)


@query(
    "catalog_parse",
    """SELECT isbn13, title, CASE WHEN partkey % 6 = 0 THEN '(unknown)' ELSE title END AS author, publisher,
        CASE WHEN partkey % 5 = 0 THEN NULL ELSE pub_date END AS pub_date, category_id, category_name, price_standard,
        coalesce(price_sales, price_standard) AS price_sales, price_tier, '' AS cover_url, 'A ' || title || ' book' AS description,
        sales_point, CASE WHEN partkey % 8 = 0 THEN NULL ELSE item_page END AS item_page, sales_point >= 50000 AS is_bestseller_flag
       FROM books_static""",
)
def catalog_parse(spark, sf):
    key = F.col("partkey")
    item = F.struct(
        "isbn13", "title",
        F.when(key % 6 == 0, "(editor only)").otherwise(F.concat("title", F.lit(" (writer), someone (artist)"))).alias("author"),
        "publisher",
        F.when(key % 5 == 0, "soon").otherwise(F.col("pub_date").cast("string")).alias("pubDate"),
        F.col("category_id").alias("categoryId"), F.col("category_name").alias("categoryName"),
        F.col("price_standard").alias("priceStandard"), F.col("price_sales").alias("priceSales"),
        F.col("sales_point").cast("string").alias("salesPoint"),
        F.concat(F.lit("<p>A <b>"), "title", F.lit("</b> book</p> ")).alias("description"),
        F.when(key % 8 != 0, F.struct(F.col("item_page").alias("itemPage"))).alias("subInfo"),
    )
    return cleanse.parse_catalog_items(fx.books_static(spark, sf).select(F.to_json(item).alias("item")))


@query(
    "catalog_first_seen",
    f"""SELECT isbn13, query_no, position, price FROM (
          SELECT *, row_number() OVER (PARTITION BY isbn13 ORDER BY query_no, position, price) AS rn FROM (
            SELECT CASE WHEN l_orderkey % 50 = 0 THEN '978' || l_partkey ELSE {ISBN.format('l_partkey')} END AS isbn13,
                   CAST(l_linenumber AS BIGINT) AS query_no, l_orderkey AS position, CAST(floor(l_extendedprice) AS BIGINT) AS price
            FROM lineitem) WHERE length(isbn13) = 13) WHERE rn = 1""",
)
def catalog_first_seen(spark, sf):
    bad = F.col("l_orderkey") % 50 == 0  # these arrive with a short number
    items = fx.table(spark, sf, "lineitem").select(
        F.when(bad, F.concat(F.lit("978"), F.col("l_partkey").cast("string"))).otherwise(F.concat(F.lit(" "), fx.isbn("l_partkey"))).alias("isbn13"),
        F.col("l_linenumber").cast("bigint").alias("query_no"), F.col("l_orderkey").alias("position"),
        F.floor("l_extendedprice").alias("price"),
    )
    return cleanse.first_seen(items, ["query_no", "position", "price"])


@query(
    "deactivate_rule",
    """SELECT isbn13, source, price_sales, active AND NOT (source = 'PUBLISHER_REQUEST' AND price_sales IS NULL AND active) AS active,
              CASE WHEN source = 'PUBLISHER_REQUEST' AND price_sales IS NULL AND active THEN 'NONE' END AS discontinue_mode,
              CASE WHEN source = 'PUBLISHER_REQUEST' AND price_sales IS NULL AND active THEN 'AUTO_DEACTIVATE_NULL_PRICE' END AS discontinue_reason
       FROM books_static""",
)
def deactivate_rule(spark, sf):
    books = fx.books_static(spark, sf).select("isbn13", "source", "price_sales", "active")
    return cleanse.deactivate_unpriced(cleanse.deactivate_unpriced(books))


def case_sql(column, mapping, default):
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN {v}" for k, v in mapping.items()) + f" ELSE {default} END"


@query(
    "key_remap",
    f"""SELECT sale_date, isbn13, CAST({case_sql('store_id', STORE_REMAP, 'store_id')} AS BIGINT) AS store_id,
               CAST({case_sql('store_id', STORE_REMAP_WH, 'wh_id')} AS BIGINT) AS wh_id, channel, qty_sold, revenue FROM sales_fact
        UNION ALL SELECT sale_date, isbn13, 2, 1, channel, qty_sold, revenue FROM sales_fact WHERE store_id = 1
        UNION ALL SELECT sale_date, isbn13, 8, 2, channel, qty_sold, revenue FROM sales_fact WHERE store_id = 7""",
)
def key_remap(spark, sf):
    sales = fx.sales_fact(spark, sf).select("sale_date", "isbn13", "store_id", "wh_id", "channel", "qty_sold", "revenue")
    return cleanse.remap_with_clones(sales, "store_id", STORE_REMAP, {1: 2, 7: 8}, also={"wh_id": (STORE_REMAP_WH, {1: 1, 7: 2})})


@query(
    "key_remap_inventory",
    f"""SELECT snapshot_date, isbn13, CAST({case_sql('location_id', LOCATION_REMAP, 'NULL')} AS BIGINT) AS location_id, on_hand FROM inventory_daily
        WHERE location_id IN ({', '.join(str(k) for k in LOCATION_REMAP)})
        UNION ALL SELECT snapshot_date, isbn13, 2, on_hand FROM inventory_daily WHERE location_id = 3
        UNION ALL SELECT snapshot_date, isbn13, 8, on_hand FROM inventory_daily WHERE location_id = 9""",
)
def key_remap_inventory(spark, sf):
    stock = fx.inventory_daily(spark, sf).select("snapshot_date", "isbn13", "location_id", "on_hand")
    return cleanse.remap_with_clones(stock, "location_id", LOCATION_REMAP, {3: 2, 9: 8}, others="drop")


@query(
    "isbn_remap",
    f"""SELECT f.feature_date, m.new_isbn AS isbn13, min(f.sns_mentions_7d) AS sns_mentions_7d, min(f.day_of_week) AS day_of_week,
               min(f.season) AS season, min(f.book_age_days) AS book_age_days
        FROM features f JOIN (SELECT isbn13 AS old_isbn, {ISBN.format('partkey // 2')} AS new_isbn FROM books_static WHERE active) m
        ON m.old_isbn = f.isbn13 GROUP BY 1, 2""",
)
def isbn_remap(spark, sf):
    books = fx.books_static(spark, sf).filter("active").withColumn("half", F.expr("partkey div 2"))
    mapping = books.select(F.col("isbn13").alias("old_isbn"), fx.isbn("half").alias("new_isbn"))
    rows = fx.features(spark, sf).select("feature_date", "isbn13", "sns_mentions_7d", "day_of_week", "season", "book_age_days")
    return cleanse.remap_isbn(rows, mapping, ["feature_date", "isbn13"])


@query(
    "sorted_bijection",
    f"""SELECT a.rank_no, a.seed_isbn, b.forecast_isbn
        FROM (SELECT isbn13 AS seed_isbn, row_number() OVER (ORDER BY isbn13) AS rank_no FROM books_static) a
        JOIN (SELECT k AS forecast_isbn, row_number() OVER (ORDER BY k) AS rank_no FROM (SELECT DISTINCT {ISBN.format('o_custkey * 7')} AS k FROM orders)) b
        ON a.rank_no = b.rank_no""",
)
def sorted_bijection_query(spark, sf):
    seeds = fx.books_static(spark, sf).select(F.col("isbn13").alias("seed_isbn"))
    other = fx.table(spark, sf, "orders").select((F.col("o_custkey") * 7).alias("k")).select(fx.isbn("k").alias("forecast_isbn"))
    return sorted_bijection(seeds, other, "seed_isbn", "forecast_isbn")


@query(
    "retention_filter",
    """SELECT 'sales' AS table_name, sale_date AS day, count(*) AS row_count FROM sales_lines
       WHERE sale_date >= (SELECT max(sale_date) FROM sales_lines) - 14 GROUP BY 2
       UNION ALL SELECT 'snapshots', snapshot_date, count(*) FROM inventory_daily
       WHERE snapshot_date >= (SELECT max(sale_date) FROM sales_lines) - 90 GROUP BY 2
       UNION ALL SELECT 'kpi', sale_date, count(*) FROM sales_fact
       WHERE sale_date >= (SELECT max(sale_date) FROM sales_lines) - 365 GROUP BY 2""",
)
def retention_filter(spark, sf):
    kept = [
        ("sales", cleanse.within_days(fx.sales_lines(spark, sf), "sale_date", 14), "sale_date"),
        ("snapshots", cleanse.within_days(fx.inventory_daily(spark, sf), "snapshot_date", 90), "snapshot_date"),
        ("kpi", cleanse.within_days(fx.sales_fact(spark, sf), "sale_date", 365), "sale_date"),
    ]
    parts = [rollups.count_by(df.withColumnRenamed(day, "day"), ["day"]).withColumn("table_name", F.lit(n)) for n, df, day in kept]
    return cleanse.union_all_by_name(parts)


@query(
    "history_expand",
    """SELECT md5(concat_ws('#', CAST(sale_date AS VARCHAR), isbn13, CAST(store_id AS VARCHAR), channel)) AS txn_id,
              CAST(sale_date AS TIMESTAMP) + INTERVAL 3 HOUR AS event_ts, store_id, wh_id, channel, isbn13, qty_sold AS qty,
              CASE WHEN qty_sold % 2 = 0 THEN revenue // qty_sold ELSE avg_price END AS unit_price, CAST(0 AS BIGINT) AS discount, revenue
       FROM sales_fact WHERE qty_sold > 0""",
)
def history_expand(spark, sf):
    sales = fx.sales_fact(spark, sf).withColumn("avg_price", F.when(F.col("qty_sold") % 2 != 0, F.col("avg_price")))
    return cleanse.expand_history(sales)


@query(
    "holiday_best",
    f"""WITH y AS ({YEARLY_SQL}), c AS (
          SELECT holiday_date, holiday_name, 0 AS priority, 0 AS position FROM holidays
          UNION ALL SELECT start_date, event_type, 1, 0 FROM y
          UNION ALL SELECT CAST(o_orderdate AS DATE), 'rush ' || o_orderpriority, 2, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
        SELECT holiday_date, holiday_name FROM (SELECT *, row_number() OVER (PARTITION BY holiday_date ORDER BY priority, position, holiday_name) AS rn FROM c)
        WHERE rn = 1""",
)
def holiday_best(spark, sf):
    zero = F.lit(0).cast("bigint")
    fixed = cal.holiday_dates(spark, fx.literal_bounds(spark, sf), HOLIDAYS).select("*", F.lit(0).alias("priority"), zero.alias("position"))
    trade = yearly_events(spark, sf).select(F.col("start_date").alias("holiday_date"), F.col("event_type").alias("holiday_name"), F.lit(1).alias("priority"), zero.alias("position"))
    rush = fx.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.to_date("o_orderdate").alias("holiday_date"), F.concat(F.lit("rush "), "o_orderpriority").alias("holiday_name"),
        F.lit(2).alias("priority"), F.col("o_orderkey").alias("position"),
    )
    return cal.best_holiday(cleanse.union_all_by_name([fixed, trade, rush]))


@query(
    "calendar_expand",
    f"""WITH y AS ({YEARLY_SQL}) SELECT event_id, event_type, start_date, end_date, start_date AS parsed_date FROM y
        UNION ALL SELECT 'order-' || o_orderkey, 'order', CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE),
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END FROM orders""",
)
def calendar_expand(spark, sf):
    trade = yearly_events(spark, sf).withColumn("text", F.date_format("start_date", "yyyyMMdd"))
    day = F.to_date("o_orderdate")
    text = F.when(F.col("o_orderkey") % 5 == 0, "2024-1-1").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    orders = fx.table(spark, sf, "orders").select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("event_id"), F.lit("order").alias("event_type"),
        day.alias("start_date"), day.alias("end_date"), text.alias("text"),
    )
    return trade.unionByName(orders).withColumn("parsed_date", cal.parse_compact_date("text")).drop("text")


CANDIDATE_SQL = """
SELECT f.isbn13, CAST(m.store_id AS BIGINT) AS store_id, f.day_of_week, f.month, coalesce(i.on_hand, 0) AS on_hand,
       CAST(f.is_holiday AS INTEGER) AS holiday_flag, f.event_nearby_days, f.sns_mentions_1d, f.sns_mentions_7d
FROM features f CROSS JOIN store_location_map m
LEFT JOIN inventory_daily i ON i.isbn13 = f.isbn13 AND i.location_id = m.inventory_location_id AND i.snapshot_date = f.feature_date
WHERE f.feature_date = (SELECT max(sale_date) FROM sales_lines)
"""


def candidates(spark, sf):
    run = fx.newest_sale(spark, sf)
    return enrich.new_book_candidates(fx.features(spark, sf), fx.inventory_daily(spark, sf), store_location_map(spark), run)


@query("batch_input_projection", CANDIDATE_SQL)
def batch_input_projection(spark, sf):
    return enrich.batch_input(candidates(spark, sf))


@query(
    "day_of_week_flags",
    """SELECT sale_date, dayofweek(sale_date) + 1 AS day_of_week, dayofweek(sale_date) IN (0, 6) AS is_weekend,
              CAST(isodow(sale_date) % 7 + 1 AS BIGINT) AS from_iso, CAST(sum(qty) AS BIGINT) AS qty FROM sales_lines GROUP BY sale_date""",
)
def day_of_week_flags(spark, sf):
    iso = F.weekday("sale_date") + 1
    return fx.sales_lines(spark, sf).groupBy("sale_date").agg(F.sum("qty").alias("qty")).select(
        "sale_date", fn.weekday("sale_date").alias("day_of_week"), fn.is_weekend("sale_date").alias("is_weekend"),
        fn.iso_weekday_to_sunday_first(iso).cast("bigint").alias("from_iso"), "qty",
    )


# Scalar function families, one query each.


@query(
    "scalar_cast",
    """SELECT p_partkey, TRY_CAST(p_name AS BIGINT) AS bad_number, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no,
              TRY_CAST(p_brand AS DATE) AS bad_date, CAST(p_size AS VARCHAR) AS size_text, CAST(p_size % 2 AS BOOLEAN) AS odd_size,
              CAST(trunc(p_retailprice) AS INTEGER) AS whole_price FROM part""",
)
def scalar_cast(spark, sf):
    return fx.table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").try_cast("bigint").alias("bad_number"), F.substring("p_brand", 7, 9).try_cast("int").alias("brand_no"),
        F.col("p_brand").try_cast("date").alias("bad_date"), F.col("p_size").cast("string").alias("size_text"),
        (F.col("p_size") % 2).cast("boolean").alias("odd_size"), F.col("p_retailprice").cast("int").alias("whole_price"),
    )


@query(
    "scalar_null",
    """SELECT isbn13, coalesce(price_sales, 15000) AS price, nullif(category_id, 7) AS not_seven, ifnull(author, '(unknown)') AS author,
              CASE WHEN price_sales IS NULL THEN 'no' ELSE 'yes' END AS has_price,
              CASE WHEN price_sales IS NULL THEN NULL ELSE greatest(price_sales, 15000) END AS strict_max FROM books_static""",
)
def scalar_null(spark, sf):
    return fx.books_static(spark, sf).select(
        "isbn13", F.coalesce("price_sales", F.lit(15000)).alias("price"), F.nullif("category_id", F.lit(7)).alias("not_seven"),
        F.ifnull("author", F.lit("(unknown)")).alias("author"), F.when(F.col("price_sales").isNull(), "no").otherwise("yes").alias("has_price"),
        fn.strict_greatest("price_sales", F.lit(15000)).alias("strict_max"),
    )


@query(
    "scalar_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END, 4) AS ratio, abs(l_quantity - 25) AS gap,
              round(sqrt(l_quantity), 4) AS root, round(pow(l_quantity, 2), 4) AS square, greatest(l_quantity, 10.0) AS at_least,
              least(l_quantity, 40.0) AS at_most, CAST(l_partkey % 7 AS BIGINT) AS rest, round(ln(1 + l_quantity), 4) AS log_q,
              round(exp(-l_quantity / 10), 4) AS decay, round(l_quantity / 2) AS half_up, round_even(l_quantity / 2, 0) AS half_even,
              CAST(l_partkey // 7 AS BIGINT) AS whole FROM lineitem""",
)
def scalar_math(spark, sf):
    q = F.col("l_quantity")
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(fn.safe_ratio("l_discount", "l_tax"), 4).alias("ratio"), F.abs(q - 25).alias("gap"),
        F.round(F.sqrt(q), 4).alias("root"), F.round(F.pow(q, F.lit(2)), 4).alias("square"), F.greatest(q, F.lit(10.0)).alias("at_least"),
        F.least(q, F.lit(40.0)).alias("at_most"), (F.col("l_partkey") % 7).alias("rest"), F.round(F.log1p(q), 4).alias("log_q"),
        F.round(F.exp(-q / 10), 4).alias("decay"), F.round(q / 2).alias("half_up"), F.bround(q / 2).alias("half_even"),
        fn.int_div("l_partkey", F.lit(7)).alias("whole"),
    )


@query(
    "scalar_date",
    """SELECT event_id, CAST(ts AS DATE) + 5 AS plus_five, CAST(ts AS DATE) - 5 AS minus_five, CAST(ts AS DATE) - DATE '2024-01-01' AS days,
              dayofweek(ts) + 1 AS day_of_week, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour,
              CAST(ts + INTERVAL 9 HOUR AS DATE) AS seoul_date, CAST(CAST(ts AS DATE) - DATE '2023-12-31' AS INTEGER) AS spine_size,
              TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'xx' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS parsed FROM events""",
)
def scalar_date(spark, sf):
    day = F.to_date("ts")
    text = F.when(F.col("event_id") % 3 == 0, "xx").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    first = F.lit("2024-01-01").cast("date")
    return fx.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).select(
        "event_id", F.date_add(day, 5).alias("plus_five"), F.date_sub(day, 5).alias("minus_five"), F.datediff(day, first).cast("bigint").alias("days"),
        fn.weekday("ts").alias("day_of_week"), F.month("ts").alias("month"), F.hour("ts").alias("hour"), fn.business_date("ts").alias("seoul_date"),
        F.size(F.sequence(first, day)).alias("spine_size"), F.try_to_timestamp(text).alias("parsed"),
    )


@query(
    "scalar_string",
    """SELECT p_partkey, p_name || '_' || p_type AS joined, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END || '#' AS null_joined,
              p_brand LIKE 'Brand#1%' AS brand_one, regexp_matches(p_name, '^[a-m]') AS early, split_part(p_name, ' ', 1) AS first_word,
              trim('  ' || p_type || ' ') AS trimmed, substr(p_name, 1, 5) AS head, regexp_replace('<b>' || p_name || '</b>', '<[^>]+>', '', 'g') AS plain
       FROM part""",
)
def scalar_string(spark, sf):
    name = F.col("p_name")
    return fx.table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit("_"), "p_type").alias("joined"),
        F.concat(F.when(F.col("p_partkey") % 3 != 0, name), F.lit("#")).alias("null_joined"), F.col("p_brand").like("Brand#1%").alias("brand_one"),
        name.rlike("^[a-m]").alias("early"), F.split(name, " ").getItem(0).alias("first_word"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"), F.substring(name, 1, 5).alias("head"),
        fn.strip_html(F.concat(F.lit("<b>"), name, F.lit("</b>"))).alias("plain"),
    )


@query(
    "scalar_array",
    """SELECT p_partkey, i AS item, concat_ws(';', 'small', CASE WHEN p_size > 25 THEN 'big' END, p_type) AS tags,
              [p_size, p_size * 2, p_size * 3][2] AS second, len(generate_series(1, p_size)) AS steps
       FROM part, (VALUES (1), (2), (3)) AS u(i) WHERE i <= p_size""",
)
def scalar_array(spark, sf):
    size = F.col("p_size")
    tags = F.array(F.lit("small"), F.when(size > 25, "big"), F.col("p_type"))
    return fx.table(spark, sf, "part").select(
        "p_partkey", F.explode(F.filter(F.sequence(F.lit(1), F.lit(3)), lambda x: x <= size)).alias("item"),
        F.array_join(F.filter(tags, lambda x: x.isNotNull()), ";").alias("tags"),
        F.element_at(F.array(size, size * 2, size * 3), 2).alias("second"), F.size(F.sequence(F.lit(1), size)).cast("bigint").alias("steps"),
    )


@query(
    "scalar_json",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, json_exists(props, '$.k') AS has_k, json_exists(props, '$.missing') AS has_missing,
              to_json({'event_id': event_id, 'kind': event_type})::VARCHAR AS state FROM events""",
)
def scalar_json(spark, sf):
    return fx.table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.array_contains(F.json_object_keys("props"), "k").alias("has_k"),
        F.array_contains(F.json_object_keys("props"), "missing").alias("has_missing"),
        F.to_json(F.struct("event_id", F.col("event_type").alias("kind"))).alias("state"),
    )


@query(
    "scalar_hash",
    """SELECT txn_id, isbn13, store_id, sale_date, CAST(('0x' || substr(md5(isbn13 || '#' || store_id || '#' || sale_date), 1, 8))::BIGINT % 100 AS BIGINT) AS bucket,
              round(('0x' || substr(sha256(isbn13 || '#' || store_id || '#' || sale_date), 1, 12))::BIGINT / 281474976710655.0, 6) AS unit FROM sales_lines""",
)
def scalar_hash(spark, sf):
    key = F.concat_ws("#", "isbn13", F.col("store_id").cast("string"), F.col("sale_date").cast("string"))
    return fx.sales_lines(spark, sf).select(
        "txn_id", "isbn13", "store_id", "sale_date", fn.hash_bucket(key).alias("bucket"), F.round(fn.hash_unit(key), 6).alias("unit")
    )
