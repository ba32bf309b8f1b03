import datetime as dt
import random

from pyspark.sql import functions as F

from shelfcast.operators import calendar as cal
from shelfcast.operators import series
from shelfcast.operators.features import build_daily_features, build_features, last_stockout, trailing_mentions

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def test_densify_matches_brute_force(spark):
    rng = random.Random(1)
    facts = {(k, rng.randrange(2, 38)): rng.randrange(1, 9) for k in "abc" for _ in range(9)}
    facts[("d", 0)] = 4
    facts[("d", 60)] = 9  # outside the period
    df = spark.createDataFrame([(k, day(i), q) for (k, i), q in facts.items()], "k string, d date, q int")
    out = series.densify(df, ["k"], "d", ["q"], F.lit(day(0)), F.lit(day(40)))
    got = {(r["k"], (r["d"] - D0).days): r["q"] for r in out.collect()}
    assert out.count() == len(got) == 4 * 41
    assert got == {(k, i): facts.get((k, i), 0) for k in "abcd" for i in range(41)}


def test_windows_never_see_the_current_day(spark):
    df = spark.createDataFrame([("a", day(i), i) for i in range(40)], "k string, d date, q int")
    out = series.with_rolling_means(series.with_lags(df, ["k"], "d", "q"), ["k"], "d", "q")
    rows = {(r["d"] - D0).days: r for r in out.collect()}
    assert rows[0]["qty_rolling_7d"] is None and rows[0]["qty_lag_1"] is None
    assert rows[3]["qty_rolling_7d"] == (0 + 1 + 2) / 3
    assert rows[30]["qty_rolling_7d"] == sum(range(23, 30)) / 7
    assert rows[30]["qty_rolling_28d"] == sum(range(2, 30)) / 28
    assert rows[30]["qty_lag_7"] == 23


def test_segments(spark):
    df = spark.createDataFrame([("a", day(i), 1 if i < 12 else 0) for i in range(42)], "k string, d date, q int")
    got = {(r["d"] - D0).days: r["demand_segment"] for r in series.with_segment(df, ["k"], "d", "q").collect()}
    assert (got[0], got[3], got[12], got[28], got[29], got[38]) == ("low", "medium", "high", "high", "medium", "low")


def test_one_sort_for_all_windows_of_a_series(spark):
    df = spark.createDataFrame([("a", day(i), i) for i in range(9)], "k string, d date, q int")
    out = series.with_rolling_means(series.with_lags(df, ["k"], "d", "q"), ["k"], "d", "q")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan and plan.count("+- Sort") <= 1


def test_next_event_days(spark):
    days = spark.createDataFrame([(day(i),) for i in range(50)], "day date")
    events = spark.createDataFrame([(day(10), "x"), (day(20), "y")], "holiday_date date, holiday_name string")
    got = {(r["day"] - D0).days: r["event_nearby_days"] for r in cal.next_event_days(days, events).collect()}
    want = {i: next((k for k in range(1, 31) if i + k in (10, 20)), 0) for i in range(50)}
    assert got == want


def test_trailing_mentions(spark):
    daily = {("a", i): (i * 5) % 7 for i in range(0, 30, 2)}
    df = spark.createDataFrame([(k, day(i), n) for (k, i), n in daily.items()], "isbn13 string, mention_date date, mentions int")
    for r in trailing_mentions(df).collect():
        i = (r["feature_date"] - D0).days
        assert r["sns_mentions_1d"] == daily.get(("a", i - 1))
        assert r["sns_mentions_7d"] == sum(daily.get(("a", j), 0) for j in range(i - 7, i))


def test_last_stockout(spark):
    spine = spark.createDataFrame([("a", day(i)) for i in range(10)] + [("b", day(3))], "isbn13 string, feature_date date")
    stock = spark.createDataFrame(
        [("a", day(2), 1, 0), ("a", day(2), 2, 0), ("a", day(6), 1, 0), ("a", day(7), 1, 5)],
        "isbn13 string, snapshot_date date, location_id int, on_hand int",
    )
    got = {(r["isbn13"], (r["feature_date"] - D0).days): r["days_since_last_stockout"] for r in last_stockout(spine, stock).collect()}
    assert len(got) == 11 and got[("b", 3)] is None
    assert [got[("a", i)] for i in range(10)] == [None, None, 0, 1, 2, 3, 0, 1, 2, 3]


def test_trailing_mentions_move_each_row_once(spark):
    df = spark.sql("SELECT '978' AS isbn13, DATE '2024-01-01' AS mention_date, 3L AS mentions")
    plan = trailing_mentions(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan
    assert plan.index("Generate") < plan.index("Exchange "), plan


def test_daily_features_are_steps_of_the_sparse_rows(spark):
    """The same as windows over every book and day, with days outside, a book listed twice, one unknown and a null key."""
    books = spark.createDataFrame(
        [("a", day(3), True), ("a", day(9), False), ("b", None, None), (None, day(1), True), ("c", day(2), False)],
        "isbn13 string, pub_date date, is_bestseller_flag boolean",
    )
    said = spark.createDataFrame(
        [("a", day(2), 5), ("a", day(4), 7), ("a", day(14), 3), ("b", day(9), None), ("b", day(9), 2), (None, day(6), 4), ("x", day(6), 4), ("a", day(40), 9)],
        "isbn13 string, mention_date date, mentions bigint",
    )
    stock = spark.createDataFrame(
        [("a", day(1), 1, 0, 0), ("a", day(8), 1, 0, 3), ("a", day(8), 2, 9, 3), ("b", day(7), 1, 4, None), ("b", day(19), 1, 0, 0), (None, day(9), 1, 0, 1),
         ("b", None, 1, 0, 1), ("x", day(8), 1, 0, 0), ("c", day(30), 1, 0, 0)],
        "isbn13 string, snapshot_date date, location_id bigint, on_hand bigint, reserved_qty bigint",
    )
    calendar = spark.createDataFrame(
        [(day(i), i == 8, None, "winter", i % 7 + 1, False, 1, 0) for i in range(4, 23)],
        "day date, is_holiday boolean, holiday_name string, season string, day_of_week bigint, is_weekend boolean, month bigint, event_nearby_days bigint",
    )
    lo, hi = F.lit(day(5)), F.lit(day(20))
    spine = books.select("isbn13", F.explode(F.sequence(lo, hi)).alias("feature_date"))
    want = build_features(spine, calendar, books, said, stock)
    got = build_daily_features(books, lo, hi, calendar, said, stock)
    assert got.schema.names == want.schema.names and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
