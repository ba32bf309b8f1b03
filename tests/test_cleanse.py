import json

from pyspark.sql import functions as F

from shelfcast.operators import cleanse
from shelfcast.sources.raw import POS_SCHEMA


def test_pos_copies_go_before_the_filters(spark, rows):
    raw = spark.createDataFrame(
        [
            ("t1", "9780000000001", 0, 10, 0, "offline", 1, "2024-01-01 10:00:00"),  # first copy, invalid
            ("t1", "9780000000001", 2, 10, 20, "offline", 1, "2024-01-01 11:00:00"),
            ("t2", "9780000000001", 3, 10, 30, "offline", 1, "2024-01-02 23:30:00"),
            ("t3", "12", 3, 10, 30, "offline", 1, "2024-01-02 10:00:00"),
            ("t4", "9780000000001", 1, 10, 10, "offline", 1, "yesterday"),
        ],
        POS_SCHEMA,
    )
    got = {r["tx_id"]: r for r in cleanse.clean_pos(raw).collect()}
    assert set(got) == {"t2", "t4"}
    assert str(got["t2"]["sale_date"]) == "2024-01-02" and got["t2"]["sale_hour"] == 23
    assert got["t4"]["ts"] is None and got["t4"]["sale_date"] is None


def test_sns_filters_before_copies(spark):
    raw = spark.createDataFrame(
        [("m", "bad", "blog", "50", "0.5", "2024-01-01 00:00:00"), ("m", "9780000000001", "blog", "x", "0.5", "2024-01-01 01:00:00")],
        "mention_id string, isbn13 string, platform string, mention_count string, sentiment_score string, collected_at string",
    )
    (row,) = cleanse.clean_sns(raw).collect()
    assert row["isbn13"] == "9780000000001" and row["mention_count"] is None and row["is_spike_seed"] is None


def test_normalize_defaults(spark):
    raw = spark.createDataFrame(
        [("t", "9780000000001", "2", "7", None, None, "3", None)],
        "tx_id string, isbn13 string, qty string, unit_price string, total_price string, channel string, location_id string, ts string",
    )
    row = cleanse.normalize_pos(raw, now=F.lit("2024-05-05 00:00:00").cast("timestamp")).first()
    assert (row["revenue"], row["wh_id"], row["discount"], row["channel"], row["store_id"]) == (14, 1, 0, "OFFLINE", 3)
    assert str(row["event_ts"]) == "2024-05-05 00:00:00"


def test_catalog_item_defaults_and_whole_texts(spark):
    item = {
        "isbn13": "9780000000001", "title": "T" * 300, "author": "Kim (writer), Lee", "publisher": "P", "pubDate": "no", "salesPoint": 50000,
        "priceStandard": 0, "description": "<b>x</b> " + "y" * 2000, "subInfo": {"itemPage": 321},
    }
    row = cleanse.parse_catalog_items(spark.createDataFrame([(json.dumps(item),)], "item string")).first()
    assert len(row["title"]) == 300 and row["author"] == "Kim" and row["pub_date"] is None
    assert (row["price_standard"], row["price_sales"], row["price_tier"]) == (15000, 15000, "MID")
    assert row["is_bestseller_flag"] and row["item_page"] == 321 and len(row["description"]) == 2002 and row["description"].startswith("x ")


def test_remap_with_clones(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (50, 9, "c")], "store_id bigint, wh_id bigint, v string")
    out = cleanse.remap_with_clones(df, "store_id", {1: 1, 2: 4}, {1: 2}, also={"wh_id": ({1: 7}, {1: 8})})
    assert rows(out) == [(1, 7, "a"), (2, 8, "a"), (4, 1, "b"), (50, 9, "c")]


def test_isbn_remap_merges_and_drops(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("b", 1, 3), ("c", 1, 9)], "isbn13 string, d int, v int")
    pairs = spark.createDataFrame([("a", "z"), ("b", "z")], "old_isbn string, new_isbn string")
    assert rows(cleanse.remap_isbn(df, pairs, ["isbn13", "d"]), "isbn13", "d", "v") == [("z", 1, 3)]


def test_deactivate_is_idempotent(spark, rows):
    df = spark.createDataFrame(
        [("a", "PUBLISHER_REQUEST", None, True), ("b", "PUBLISHER_REQUEST", 5, True), ("c", "CATALOG", None, True)],
        "isbn13 string, source string, price_sales int, active boolean",
    )
    once = cleanse.deactivate_unpriced(df)
    assert [r[0] for r in rows(once.filter("NOT active"), "isbn13")] == ["a"]
    assert rows(cleanse.deactivate_unpriced(once)) == rows(once)


def test_history_expand(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "a", 1, 1, "offline", 2, 9, None), ("2024-01-01", "b", 1, 1, "offline", 0, 9, None)],
        "sale_date string, isbn13 string, store_id bigint, wh_id bigint, channel string, qty_sold bigint, revenue bigint, avg_price bigint",
    ).withColumn("sale_date", F.col("sale_date").cast("date"))
    (row,) = cleanse.expand_history(df).collect()
    assert row["unit_price"] == 4 and str(row["event_ts"]) == "2024-01-01 03:00:00"


def test_export_widths(spark):
    df = spark.createDataFrame([("T" * 300, "d")], "title string, description string")
    assert [len(v) for v in cleanse.cut_to_widths(df, {"title": 200, "description": 1000}).first()] == [200, 1]


def test_a_copy_without_a_time_does_not_win(spark):
    rows = [("t1", "9788900000004", 2, "not a time"), ("t1", "9788900000004", 2, "2024-01-05 10:00:00")]
    (row,) = cleanse.clean_pos(spark.createDataFrame(rows, "tx_id string, isbn13 string, qty int, ts string")).collect()
    assert str(row["sale_date"]) == "2024-01-05"
