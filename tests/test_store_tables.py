"""Store tables cover the whole period with sales."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from check import TABLES, bag

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["rolling_sum_segment", "training_dataset_store", "pretrain_gate"])
def test_store_tables_equal_sql_over_every_day(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert bag(df.columns, rows) == bag(names, cur.fetchall())


def above_the_days(df):
    """The plan nodes that the rows pass after a series is stretched over its days."""
    path = []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        path = [(d, n) for d, n in path if d < depth] + [(depth, line.strip(" :+-"))]
        if "Generate explode(sequence(" in line:
            return [n for _, n in path[:-1]]
    raise AssertionError("no days")


@pytest.mark.parametrize("name,sorts", [("training_dataset_store", 0), ("rolling_sum_segment", 0), ("training_dataset_wh", 1), ("automl_input", 0), ("dense_enrich", 0)])
def test_dense_rows_are_never_moved(spark, name, sorts):
    nodes = above_the_days(entry.queries()[name](spark, SF))
    assert len(nodes) > 3
    first_sum = max((i for i, n in enumerate(nodes) if "HashAggregate" in n), default=-1)
    dense = nodes[first_sum + 1 :]
    assert not [n for n in dense if n.startswith("Exchange")]
    assert len([n for n in dense if n.startswith("Sort ")]) <= sorts


def test_history_of_sparse_rows_equals_windows_over_dense_ones(spark):
    import random
    from datetime import date, timedelta

    from pyspark.sql import functions as F

    from shelfcast.operators import series

    rng, lo = random.Random(4), date(2024, 2, 20)
    days = [lo + timedelta(n) for n in range(60)]
    rows = [(k, lo, 0, 7) for k in range(6)]
    rows += [(k, d, rng.choice([0, 0, 1, 5, -2, None]), rng.randrange(9)) for k in range(5) for d in days[1:] if rng.random() < 0.2 * k]
    facts = spark.createDataFrame(rows, "k int, d date, q long, s long")
    ends = [F.lit(days[0]), F.lit(days[-1])]
    dense = series.densify(facts.fillna(0, ["q"]), ["k"], "d", ["q", "s"], *ends)
    want = series.with_segment(series.with_rolling_means(series.with_lags(dense, ["k"], "d", "q"), ["k"], "d", "q"), ["k"], "d", "q")
    got = series.densify_with_history(facts, ["k"], "d", ["q", "s"], *ends, "q")
    got = got.select("k", "d", "q", "s", "_lag_1", "_lag_7", series.mean_before(7).alias("a"), series.mean_before(28).alias("b"), series.segment_of(F.col("_sum_28")).alias("c"))
    read = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert read(got) == read(want)
    assert got.count() == 6 * 60


def test_panel_windows_equal_windows_over_dense_rows(spark):
    import random
    from datetime import date, timedelta

    from pyspark.sql import functions as F

    from shelfcast.operators import series

    rng, lo = random.Random(9), date(2024, 2, 20)
    days = [lo + timedelta(n) for n in range(90)]
    rows = [(k, lo, 0) for k in range(6)]
    rows += [(k, d, rng.choice([0, 1, 5, -2])) for k in range(5) for d in days[1:] if rng.random() < 0.2 * k]
    facts = spark.createDataFrame(rows, "k int, d date, q long")
    ends = [F.lit(days[0]), F.lit(days[-1])]
    dense = series.densify(facts, ["k"], "d", ["q"], *ends)
    want = series.with_rolling_means(series.with_lags(dense, ["k"], "d", "q"), ["k"], "d", "q")
    want = series.with_intermittent_stats(want, ["k"], "d", "q")
    got = series.densify_with_windows(facts, ["k"], "d", ["q"], *ends, "q", lags=(1, 7), spans=(7, 28), lookback=56).select(*want.columns)
    read = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert got.dtypes == want.dtypes
    assert read(got) == read(want)


@pytest.mark.parametrize("name", ["lag_features", "rolling_mean", "intermittent_stats", "forecast_error_metrics"])
def test_panel_windows_do_not_sort_dense_rows(spark, name):
    nodes = above_the_days(entry.queries()[name](spark, SF))
    first_sum = max(i for i, n in enumerate(nodes) if "HashAggregate" in n)
    assert not [n for n in nodes[first_sum + 1 :] if n.startswith(("Sort ", "Window"))]


def test_intermittent_backtest_brings_its_windows(spark):
    from shelfcast.catalog.series_queries import store_panel
    from shelfcast.plans import backtest

    panel = store_panel(spark, SF, 84, backtest.INTERMITTENT)
    nodes = above_the_days(backtest.intermittent_inputs(panel, ["isbn13", "store_id"], 14, 56))
    assert not [n for n in nodes if n.startswith(("Sort ", "Window"))]


def test_days_of_books_are_neither_moved_nor_sorted(spark):
    nodes = above_the_days(entry.queries()["features_build"](spark, SF))
    first_sum = max(i for i, n in enumerate(nodes) if "HashAggregate" in n)
    dense = nodes[first_sum + 1 :]
    assert dense and not [n for n in dense if n.startswith(("Exchange", "Sort ", "Window"))]


def test_warehouse_windows_are_steps_but_for_books_that_lose_days(spark):
    from datetime import date, timedelta

    from pyspark.sql import functions as F

    from shelfcast.domain import locations_static, store_location_map
    from shelfcast.operators.series import with_lags, with_rolling_means
    from shelfcast.plans import training

    lo = date(2024, 3, 1)

    def d(n):
        return lo + timedelta(n)

    sold = [("a", 0, 2), ("a", 3, 5), ("a", 11, 1), ("a", 39, 7), ("b", 1, 4), ("b", 4, 6), ("b", 5, 1), ("b", 20, 3), (None, 2, 9)]
    sales = spark.createDataFrame([(d(n), k, s, 1, q, 10, 1) for k, n, q in sold for s in (1, 2)], "sale_date date, isbn13 string, store_id bigint, wh_id bigint, qty_sold bigint, revenue bigint, tx_count bigint")
    stock = spark.createDataFrame([(d(3), "a", 1, 8, 1), (d(7), "b", 15, 4, 0)], "snapshot_date date, isbn13 string, location_id bigint, on_hand bigint, reserved_qty bigint")
    ages = [("a", n, n + 3) for n in (0, 3, 5)] + [("b", n, n - 6) for n in (1, 4, 5, 9)]  # b sells before its launch
    features = spark.createDataFrame(
        [(k, d(n), False, 1, 3, False, 2, 1, 4, age, None) for k, n, age in ages],
        "isbn13 string, feature_date date, is_holiday boolean, day_of_week bigint, month bigint, is_weekend boolean, event_nearby_days bigint, sns_mentions_1d bigint, "
        "sns_mentions_7d bigint, book_age_days bigint, days_since_last_stockout bigint",
    )
    books = spark.createDataFrame(
        [("a", 1, "LOW", 5, True, 2), ("b", 2, "MID", None, None, None), ("b", 3, "MID", 4, None, 1)],
        "isbn13 string, category_id bigint, price_tier string, sales_point bigint, is_bestseller_flag boolean, author_experience_years bigint",
    )
    places = store_location_map(spark), locations_static(spark)
    period = F.lit(lo), F.lit(d(39))
    keys = ["isbn13", "wh_id"]
    for drop in (True, False):
        want = training.enriched_warehouse_panel(sales, stock, features, *places, period)
        want = want.filter("book_age_days >= 0") if drop else want
        want = training.with_book(with_rolling_means(with_lags(want, keys, "feature_date", "qty_sold"), keys, "feature_date", "qty_sold"), books)
        got = training.training_dataset_wh(sales, stock, features, books, *places, drop_prelaunch=drop, period=period)
        assert sorted(got.columns) == sorted(want.columns)
        assert bag(want.columns, [tuple(r) for r in got.select(*want.columns).collect()]) == bag(want.columns, [tuple(r) for r in want.collect()])


def test_warehouse_table_does_not_sort_dense_rows(spark):
    nodes = above_the_days(entry.queries()["training_dataset_wh"](spark, SF))
    first_sum = max(i for i, n in enumerate(nodes) if "HashAggregate" in n)
    assert not [n for n in nodes[first_sum + 1 :] if n.startswith(("Sort ", "Window", "Exchange"))]


def test_books_are_joined_before_series_are_stretched(spark):
    for name in ("training_dataset_store", "automl_input", "dense_enrich", "training_dataset_wh"):
        nodes = above_the_days(entry.queries()[name](spark, SF))
        assert not [n for n in nodes if "Join" in n and "isbn13" in n], name


def test_lead_in_days_are_not_stretched(spark):
    from shelfcast.catalog import fixtures as fx
    from shelfcast.catalog.series_queries import train_store
    from shelfcast.operators.series import last_days

    want = last_days(train_store(spark, SF, 14 + 28), "feature_date", 14, fx.newest_sale(spark, SF))
    got = train_store(spark, SF, 14 + 28, 14)
    rows = [tuple(r) for r in got.collect()]
    assert bag(got.columns, rows) == bag(want.columns, [tuple(r) for r in want.collect()])
    assert len(rows) == 200 * 14 * 14
