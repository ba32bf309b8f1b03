"""Dense tables: few columns in each row's work, equal rows counted first, nothing stored that is read once."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfcast.catalog import fixtures as fx
from shelfcast.catalog import plan_queries
from shelfcast.catalog.join_queries import wh_panel
from shelfcast.catalog.series_queries import store_panel
from shelfcast.catalog.util import digest
from shelfcast.operators import scoring, series
from shelfcast.plans import backtest, gates
from shelfcast.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("make", [store_panel, wh_panel])
def test_sparse_partitions_are_not_merged_before_they_grow(spark, make):
    lines = plan(make(spark, SF)).splitlines()
    at = next(i for i, x in enumerate(lines) if "Generate explode(sequence(" in x)
    assert "REPARTITION_BY_NUM" in next(x for x in lines[at:] if "Exchange" in x)


def test_pretrain_gate_does_not_store_the_whole_table(spark, monkeypatch):
    stored, real = [], tables.through_disk
    monkeypatch.setattr(tables, "through_disk", lambda s, df, label: stored.append(label) or real(s, df, label))
    gate = plan_queries.pretrain_gate(spark, SF)
    assert "train-store" not in stored
    assert gate.first()["store_count"] == 14


def test_places_are_counted_with_the_series(spark):
    rows = [(b, s, date(2024, 1, 1 + d), d % 2, 1 if d else None) for b in "ab" for s in (1, 2, None) for d in range(3) if (b, s) != ("b", 2)]
    table = spark.createDataFrame(rows, "isbn13 string, store_id bigint, feature_date date, qty_sold bigint, month bigint")
    got = gates.training_metrics(table, ["isbn13", "store_id"], ["month"], place="store_id").first().asDict()
    assert got.pop("store_count") == table.groupBy("store_id").count().count() == 3
    assert got == gates.training_metrics(table, ["isbn13", "store_id"], ["month"]).first().asDict()
    assert gates.training_metrics(table.limit(0), ["isbn13", "store_id"], ["month"], place="store_id").first()["series_count"] == 0


def test_counted_scores_have_the_metrics_of_all_rows(spark):
    rng, lo = random.Random(3), date(2024, 1, 1)
    rows = [(k, lo + timedelta(d), rng.choice([0, 0, 0, 2, 5])) for k in "abcd" for d in range(70)]
    panel = spark.createDataFrame(rows, "isbn13 string, feature_date date, qty_sold bigint").withColumn("wh_id", F.lit(1))
    every = backtest.baseline_scores(panel, ["isbn13", "wh_id"])
    counted = backtest.baseline_scores(panel, ["isbn13", "wh_id"], counted=True)
    assert counted.count() < every.count() == counted.agg(F.sum("_n")).first()[0]
    close = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in read(df)]
    assert close(scoring.error_metrics(counted, ["model"], weight="_n")) == close(scoring.error_metrics(every, ["model"]))


def test_rows_without_a_prediction_count_but_have_no_quantile(spark):
    scored = spark.createDataFrame([("m", 1.0, 2.0), ("m", 1.0, 2.0), ("m", 3.0, None)], "model string, actual double, predicted double")
    row = scoring.error_metrics(scored, ["model"]).first()
    assert (row["row_count"], row["actual_sum"], row["p50_abs_error"]) == (3, 5.0, 1.0)


def test_equal_rows_of_the_ensemble_are_counted_first(spark):
    rng = random.Random(5)
    rows = [(float(rng.choice([0, 0, 2])), rng.choice(["high", "low", None]), rng.choice([0.0, 0.5]), rng.choice([0.0, 1.5]), 0.25) for _ in range(200)]
    table = spark.createDataFrame(rows, "actual double, demand_segment string, m1 double, m2 double, m3 double")
    weights = backtest.ensemble_weights(table, ["m1", "m2", "m3"])
    assert "keys=[actual" in plan(weights)
    total = sum(r[0] for r in rows)
    for w in weights.collect():
        diffs = [r[0] - (r[2] * w["w1"] + r[3] * w["w2"] + r[4] * w["w3"]) for r in rows]
        assert w["wape"] == pytest.approx(sum(abs(d) for d in diffs) / total)
        assert w["fill_rate_proxy"] == pytest.approx(1 - sum(max(d, 0) for d in diffs) / total)


def test_digest_of_counted_rows_equals_the_plain_one(spark):
    rng, lo = random.Random(8), date(2024, 1, 1)
    rows = [(k, lo + timedelta(d), rng.choice([0, 0, 7, None]), d % 7, rng.choice([0.5, None]), rng.choice(["x", None])) for k in ("a", "b", None) for d in range(90)]
    rows.append(("c", None, 3, None, None, None))
    table = spark.createDataFrame(rows, "k string, d date, q bigint, dow bigint, m double, t string")
    columns = dict(keys=["k"], day="d", ints=["q", "dow"], floats=["m"], texts=["t"])
    plain = digest(table, **columns)
    for daily in (["dow"], []):
        counted = digest(table, **columns, daily=daily)
        assert counted.dtypes == plain.dtypes
        assert read(counted) == read(plain)


def test_held_columns_are_found_once_a_stretch(spark):
    lo, hi = date(2024, 2, 25), date(2024, 3, 9)
    facts = spark.createDataFrame([("a", date(2024, 2, 28), 3, 5), ("a", hi, 1, None), ("b", lo, 0, 2)], "k string, d date, q bigint, c bigint")
    hold = lambda rows: rows.withColumn("e", F.coalesce("c", F.lit(-1)) * 2)
    ends = F.lit(lo), F.lit(hi)
    for dense in (
        series.densify(facts, ["k"], "d", ["q"], *ends, sparse=["c"], hold=hold),
        series.densify_with_history(facts, ["k"], "d", ["q"], *ends, "q", sparse=["c"], hold=hold).select("k", "d", "q", "c", "e"),
    ):
        rows = {r[:2]: r[2:] for r in read(dense)}
        assert len(rows) == 2 * 14
        assert rows["a", date(2024, 2, 28)] == (3, 5, 10)
        assert rows["a", hi] == (1, None, -2)
        assert rows["b", lo] == (0, 2, 4)
        assert rows["a", date(2024, 2, 29)] == rows["a", lo] == rows["b", hi] == (0, None, -2)


def test_store_table_joins_nothing_to_dense_rows(spark):
    lines = plan(entry.queries()["training_dataset_store"](spark, SF)).splitlines()
    at = next(i for i, x in enumerate(lines) if "Generate explode(sequence(" in x)
    assert not [x for x in lines[:at] if "Join" in x]


def test_covariates_leave_out_what_is_not_asked_for(spark):
    shown = plan(gates.training_metrics(plan_queries.train_store(spark, SF), ["isbn13", "store_id"]))
    assert "_daily_sns_mentions_7d" not in shown


def test_day_numbers_give_the_weekdays(spark):
    from shelfcast.functions.columns import weekday, weekday_of_date

    days = spark.sql("SELECT explode(sequence(DATE '1969-12-20', DATE '1970-01-20')) AS d").union(spark.sql("SELECT CAST(NULL AS DATE) AS d"))
    assert not days.filter(~weekday_of_date("d").eqNullSafe(weekday("d"))).collect()


def test_warehouse_table_asks_for_prelaunch_books_first(spark):
    from shelfcast.catalog.series_queries import train_wh

    assert plan(train_wh(spark, SF)).count("Generate explode(sequence(") == 1
    assert fx.features(spark, SF).filter("book_age_days < 0").isEmpty()
