import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfcast.catalog import plan_queries
from shelfcast.domain import CATEGORICAL_FEATURES, NUMERIC_FEATURES, locations_static, store_location_map
from shelfcast.operators import enrich, rollups, scoring
from shelfcast.plans import backtest, gates, models, policy, stock, training

D0 = dt.date(2024, 3, 1)
LOCATIONS = "location_id int, location_type string, wh_id int, name string, size string, region string, is_virtual boolean, active boolean"


def two_stores(spark):
    places = spark.createDataFrame(
        [(1, "STORE_OFFLINE", 1, "a", "L", "r", False, True), (2, "STORE_OFFLINE", 1, "b", "S", "r", False, True)], LOCATIONS
    )
    links = spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "store_id int, location_id int, inventory_location_id int")
    return links, places


def allocated(spark, mode, sold_by=(1,)):
    links, places = two_stores(spark)
    wh = spark.createDataFrame(
        [(D0, D0 + dt.timedelta(days=i), "x", 1, 10.0, 5.0, 15.0) for i in range(1, 6)],
        "prediction_date date, target_date date, isbn13 string, wh_id bigint, predicted_demand double, confidence_low double, confidence_high double",
    )
    sales = spark.createDataFrame([(D0, "x", s, 3) for s in sold_by], "sale_date date, isbn13 string, store_id bigint, qty_sold bigint") if sold_by else spark.createDataFrame([], "sale_date date, isbn13 string, store_id bigint, qty_sold bigint")
    out = policy.allocate_to_stores(wh, sales, links, places, F.lit(D0), mode)
    return {r["store_id"]: r["predicted_demand"] for r in out.filter(F.col("target_date") == D0 + dt.timedelta(days=1)).collect()}


def test_allocation_modes(spark):
    assert allocated(spark, "normalized") == {1: 10.0, 2: 0.0}
    assert allocated(spark, "normalized", ()) == {1: 5.0, 2: 5.0}
    assert allocated(spark, "as_written") == {1: 10.0, 2: 25.0}  # equal share five times over
    assert allocated(spark, "as_written", ()) == {1: 25.0, 2: 25.0}


def test_shares_add_up_to_one(spark):
    stores = policy.stores_per_warehouse(store_location_map(spark), locations_static(spark))
    series = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "isbn13 string, wh_id bigint")
    recent = spark.createDataFrame([("x", 1, 5, 1), ("x", 3, 7, 1)], "isbn13 string, store_id bigint, store_qty bigint, wh_id bigint")
    sums = policy.demand_shares(series, stores, recent).groupBy("isbn13", "wh_id").agg(F.sum("demand_share").alias("s"))
    assert all(abs(r["s"] - 1) < 1e-12 for r in sums.collect()) and sums.count() == 3


def test_rollup_keeps_the_sum(spark):
    rows = spark.createDataFrame([(D0, D0, "x", s, float(s), 0.0, 1.0) for s in range(1, 15)], "prediction_date date, target_date date, isbn13 string, store_id bigint, predicted_demand double, confidence_low double, confidence_high double")
    out = policy.roll_up_to_warehouse(rows, store_location_map(spark), locations_static(spark))
    assert out.agg(F.sum("predicted_demand")).first()[0] == sum(range(1, 15)) and out.count() == 2


def test_policy_and_bounds(spark):
    rows = spark.createDataFrame(
        [("high", -3.0, 1.0, 2.0, "L"), ("high", 4.0, 1.0, 2.0, "L"), ("medium", 9.0, 1.5, 2.0, "S"), ("low", 9.0, 1.5, None, "S"), (None, 9.0, 1.5, 2.5, "S"), ("odd", 9.0, 1.5, 2.5, "S")],
        "demand_segment string, score double, qty_rolling_7d double, qty_rolling_28d double, store_size string",
    )
    rules = [{"column": "store_size", "value": "L", "segment": "high", "multiplier": 1.5}, {"column": "absent", "value": "x", "segment": "high", "multiplier": 9}]
    out = policy.policy_predict(rows, F.col("score"), {"high": 2.0}, rules, model_segments=("high",), medium="ma7", low="ma28")
    assert [r["predicted_demand"] for r in out.collect()] == [0.0, 12.0, 1.5, 0.0, 2.5, 2.5]
    b = policy.confidence_bounds(out, {"high": 1.3, "medium": 0.5}).collect()
    assert all(r["confidence_low"] <= r["predicted_demand"] <= r["confidence_high"] for r in b)
    assert b[1]["confidence_high"] == pytest.approx(12 * 1.1) and b[1]["confidence_low"] == pytest.approx(12 / 1.3)
    assert b[2]["confidence_low"] == b[2]["predicted_demand"] and b[4]["confidence_low"] == pytest.approx(2.5 * 0.75)


def test_error_metrics_by_hand(spark):
    rows = [(0.0, 0.0), (0.0, 2.0), (4.0, 1.0), (4.0, 1.0)]
    scored = spark.createDataFrame([("m", a, p) for a, p in rows], "model string, actual double, predicted double")
    m = scoring.error_metrics(scored, ["model"]).first()
    assert (m["row_count"], m["mae"], m["wape"]) == (4, 2.0, 1.0)
    assert m["rmse"] == pytest.approx(math.sqrt(22 / 4)) and m["bias"] == -1.0
    assert m["smape"] == pytest.approx((2 / 1 + 3 / 2.5 + 3 / 2.5) / 3)  # the 0/0 row is left out
    assert m["underforecast_rate"] == 0.5 and m["fill_rate_proxy"] == pytest.approx(1 - 6 / 8)
    c = scoring.order_cost(scoring.error_metrics(scored, ["model"])).first()
    assert c["weighted_order_cost"] == 6 * 3 + 2 and c["weighted_order_cost_rate"] == pytest.approx(20 / 8)


def test_factor_is_clamped(spark):
    scored = spark.createDataFrame([("m", "high", 10.0, 1.0), ("m", "low", 1.0, 10.0), ("m", "medium", 5.0, 0.0)], "model string, demand_segment string, actual double, predicted double")
    got = {r["demand_segment"]: r["calibration_factor"] for r in scoring.calibration_factors(scored).collect()}
    assert got == {"high": 2.0, "low": 0.5, "medium": 1.0}


def test_ensemble_grid(spark):
    assert len(backtest.weight_grid()) == 66
    rows = spark.createDataFrame([("high", 4.0, 4.0, 0.0, 9.0), ("low", 2.0, 2.0, 0.0, 9.0)], "demand_segment string, actual double, a double, b double, c double")
    mixes = backtest.ensemble_weights(rows, ["a", "b", "c"])
    assert sorted(r["rank"] for r in mixes.collect()) == list(range(1, 67))
    best = mixes.filter("rank = 1").first()
    assert (best["w1"], best["score"], best["wape"]) == (1.0, 0.0, 0.0)


def test_gates(spark):
    worst = gates.promotion_gate(spark.createDataFrame([("all", 0.1, 0.99, 0.1)], "demand_segment string, wape double, fill_rate_proxy double, underforecast_rate double")).first()
    assert not worst["passed"] and "high_wape_above_threshold" in worst["reject_reasons"] and "all_wape" not in worst["reject_reasons"]
    panel = spark.createDataFrame([("x", 1, D0, 0)], "isbn13 string, wh_id int, feature_date date, qty_sold int")
    with pytest.raises(gates.GateError):
        gates.require_fresh(panel, F.lit(D0 + dt.timedelta(days=5)))
    gates.require_fresh(panel, F.lit(D0 + dt.timedelta(days=1)))
    with pytest.raises(gates.GateError):
        gates.require_passed(spark.createDataFrame([("FAILED", "x")], "validation_status string, reject_reason string"))


def test_quality_of_an_empty_run_fails(spark):
    none = spark.createDataFrame([], "prediction_date date, target_date date, isbn13 string, store_id bigint, predicted_demand double, confidence_low double, confidence_high double")
    row = gates.forecast_quality(none, F.lit(D0)).first()
    assert row["row_count"] == 0 and row["passed"] is False


ORDER = "order_id string, status string, rejection_stage string, dispatched_at timestamp, executed_at timestamp"


def test_order_rules(spark, rows):
    t = dt.datetime(2024, 1, 1)
    good = [
        ("g1", "PENDING", None, None, None), ("g2", "IN_TRANSIT", None, t, None), ("g3", "EXECUTED", None, t, t),
        ("g4", "REJECTED", "IN_TRANSIT", t, None), ("g5", "REJECTED", "PENDING", None, None), ("g6", None, None, None, None),
    ]
    bad = [
        ("b1", "PENDING", None, t, None), ("b2", "EXECUTED", None, t, None), ("b3", "PENDING", "PENDING", None, None),
        ("b4", "REJECTED", None, None, None), ("b5", "REJECTED", "LOST", t, None), ("b6", "EXECUTED", None, None, t),
    ]
    found = stock.order_violations(spark.createDataFrame(good + bad, ORDER))
    assert [r[0] for r in rows(found, "order_id")] == ["b1", "b2", "b3", "b4", "b5", "b6"]


def test_panel_needs_unique_stock_rows(spark):
    sales = spark.createDataFrame([(D0, "x", 1, 2)], "sale_date date, isbn13 string, store_id bigint, qty_sold bigint")
    twice = spark.createDataFrame([(D0, "x", 1, 5, 0, 1)] * 2, "snapshot_date date, isbn13 string, location_id bigint, on_hand bigint, reserved_qty bigint, safety_stock bigint")
    books = spark.createDataFrame([("x",)], "isbn13 string")
    with pytest.raises(Exception, match="two rows"):
        training.store_panel(sales, twice, books, store_location_map(spark), spark.createDataFrame([(1,), (2,)], "store_id bigint")).collect()
    ok = training.store_panel(sales, twice.limit(1), books, store_location_map(spark), spark.createDataFrame([(1,), (2,)], "store_id bigint"))
    assert {(r["store_id"], r["qty_sold"], r["on_hand"]) for r in ok.collect()} == {(1, 2, 5), (2, 0, 0)}


def test_online_stock_by_parameter(spark):
    sales = spark.createDataFrame([(D0, "x", 13, 2)], "sale_date date, isbn13 string, store_id bigint, qty_sold bigint")
    house = spark.createDataFrame([(D0, "x", 15, 50, 0, 1)], "snapshot_date date, isbn13 string, location_id bigint, on_hand bigint, reserved_qty bigint, safety_stock bigint")
    books = spark.createDataFrame([("x",)], "isbn13 string")
    at = lambda via: training.store_panel(sales, house, books, store_location_map(spark), spark.createDataFrame([(13,)], "store_id bigint"), via).first()["on_hand"]
    assert at("store") == 0 and at("inventory_location") == 50


def test_future_rows(spark):
    rows = [("x", 1, D0 + dt.timedelta(days=i), 3, 10, 1, 2, 5, 0, 0, 0) for i in range(3)]
    df = spark.createDataFrame(rows, "isbn13 string, wh_id int, feature_date date, event_nearby_days int, book_age_days int, holiday_flag int, day_of_week int, month int, weekend_flag int, days_since_last_stockout int, q int")
    out = policy.future_features(df, ["isbn13", "wh_id"]).orderBy("target_date").collect()
    assert [str(r["target_date"]) for r in out] == ["2024-03-04", "2024-03-05", "2024-03-06", "2024-03-07", "2024-03-08"]
    assert [r["event_nearby_days"] for r in out] == [2, 1, 0, 0, 0] and out[0]["book_age_days"] == 11 and out[0]["day_of_week"] == 2
    fixed = policy.future_features(df, ["isbn13", "wh_id"], anchor="run_date", run_date=F.lit(D0)).agg(F.min("target_date")).first()[0]
    assert str(fixed) == "2024-03-02"


def test_cooldown_against_brute_force(spark):
    import random

    rng = random.Random(2)
    t0 = dt.datetime(2024, 1, 1)
    make = lambda n: [(rng.choice("ab"), t0 + dt.timedelta(minutes=rng.randrange(600))) for _ in range(n)]
    found, past = make(80), make(15)
    out = enrich.without_recent(
        spark.createDataFrame(found, "isbn13 string, at timestamp"), spark.createDataFrame(past, "isbn13 string, at timestamp"), "isbn13", "at"
    )
    gap = dt.timedelta(minutes=30)
    want = [(k, a) for k, a in found if not any(k == k2 and a - gap < b < a for k2, b in past)]
    assert sorted((r["isbn13"], r["at"]) for r in out.collect()) == sorted(want)


def test_poisson_rounding(spark):
    counts = spark.createDataFrame([("a", 20, 5.0), ("b", 3, None), ("c", 9, 0.0), ("d", 500, 4.0)], "isbn13 string, mentions_count int, baseline_lam double")
    got = {r["isbn13"]: (r["z_score"], r["predicted_qty"]) for r in rollups.poisson_spikes(counts).collect()}
    assert got == {"a": (6.71, 201), "d": (248.0, 400)}


def test_group_rules(spark):
    rows = [("high", "L", "x", 3.0, 1.0)] * 30 + [("high", "S", "x", 1.0, 1.0)] * 30 + [("high", "M", "y", 9.0, 1.0)] * 3
    df = spark.createDataFrame(rows, "demand_segment string, store_size string, channel string, actual double, predicted double")
    out = backtest.group_multipliers(df, ["store_size"], service_level=0.9, cap=2.5, min_rows=10).collect()
    assert [(r["column"], r["value"], r["multiplier"], r["train_rows"]) for r in out] == [("store_size", "L", 2.5, 30)]


def test_company_row_counts_every_book_once(spark):
    lines = spark.range(3000).select(
        F.concat(F.lit("b"), (F.col("id") % 1500).cast("string")).alias("isbn13"), F.lit("2024-01-01").cast("date").alias("sale_date"),
        (F.col("id") % 2 + 1).alias("store_id"), F.lit("offline").alias("channel"), F.when(F.col("id") % 1500 == 7, 5).otherwise(1).alias("qty"), F.lit(10).alias("revenue"),
    )
    (row,) = rollups.with_company_total(lines).filter("store_id = 0").collect()
    assert (row["unique_isbn_count"], row["tx_count"], row["top_isbn"], row["channel"]) == (1500, 3000, "b7", "ALL")


def test_new_book_quantities_for_any_warehouse(spark):
    rows = spark.createDataFrame([("x", 1, 4), ("x", 3, 5), ("x", 3, 6)], "isbn13 string, wh_id bigint, predicted_30d_qty bigint")
    assert sorted(tuple(r) for r in models.new_book_wh_quantity(rows).collect()) == [("x", 1, 4), ("x", 3, 11)]


def test_covariates_move_each_book_once(spark):
    from shelfcast.operators import calendar as cal
    from shelfcast.operators import features as feat

    day = lambda n: D0 + dt.timedelta(days=n)
    spine = spark.createDataFrame([("a", day(n)) for n in range(0, 12)], "isbn13 string, feature_date date")
    stock = spark.createDataFrame([("a", day(2), 1, 0, 0), ("a", day(2), 2, 5, 1), ("a", day(5), 1, 3, 9)], "isbn13 string, snapshot_date date, location_id int, on_hand int, reserved_qty int")
    said = spark.createDataFrame([("a", day(1), 10), ("a", day(3), 5)], "isbn13 string, mention_date date, mentions bigint")
    books = spark.createDataFrame([("a", day(-3), True)], "isbn13 string, pub_date date, is_bestseller_flag boolean")
    bounds = spark.sql(f"SELECT DATE '{day(0)}' AS lo, DATE '{day(11)}' AS hi")
    made = feat.build_features(spine, cal.calendar_table(bounds, cal.holiday_dates(spark, bounds, [(1, 1, "New Year")])), books, said, stock)
    got = {(r["feature_date"] - D0).days: (r["sns_mentions_1d"], r["sns_mentions_7d"], r["on_hand_total"], r["days_since_last_stockout"]) for r in made.collect()}
    assert got[1] == (0, 0, 0, None) and got[2] == (10, 10, 4, 0) and got[4] == (5, 15, 0, 2) and got[8] == (0, 15, 0, 6) and got[9] == (0, 5, 0, 7) and got[11] == (0, 0, 0, 9)
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Window [") == 1


def test_metrics_of_a_fitted_model_read_stored_scores(spark, monkeypatch):
    """The model ran once for each branch of the metrics, and rows of all groups met in one task by a join with the cut points."""
    names = [c for c in CATEGORICAL_FEATURES if c != "demand_segment"]
    split = spark.range(80).select(
        *[((F.col("id") * (i + 3)) % 7).cast("double").alias(c) for i, c in enumerate(NUMERIC_FEATURES)],
        *[F.concat(F.lit("v"), F.col("id") % 2).alias(c) for c in names],
        F.when(F.col("id") % 3 == 0, "high").otherwise("medium").alias("demand_segment"),
        F.when(F.col("id") < 60, "train").otherwise("holdout").alias("split_name"), (F.col("id") % 5).alias("qty_sold"),
    )
    monkeypatch.setattr(plan_queries, "train_store", lambda *_: None)
    monkeypatch.setattr(plan_queries.fx, "newest_sale", lambda *_: None)
    monkeypatch.setattr(plan_queries.training, "holdout_split", lambda *_, **__: split)
    got = plan_queries.fitted_demand(spark, "", "poisson", "poisson")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan
    assert "_salt" not in plan
    rows = split.filter("split_name = 'holdout'").select("demand_segment", "qty_sold", "qty_rolling_28d").collect()
    found = {(r["model"], r["demand_segment"]): r for r in got.collect()}
    assert sorted(found) == sorted((m, d) for m in ("ma28", "poisson") for d in ("all", "high", "medium"))
    for d in ("all", "high", "medium"):
        errors = [abs(r["qty_sold"] - r["qty_rolling_28d"]) for r in rows if d in ("all", r["demand_segment"])]
        one = found["ma28", d]
        assert (one["row_count"], found["poisson", d]["row_count"]) == (len(errors),) * 2
        assert one["mae"] == pytest.approx(sum(errors) / len(errors), abs=1e-4)
        low, high = (sorted(errors)[f((len(errors) - 1) / 2)] for f in (math.floor, math.ceil))
        assert one["p50_abs_error"] == pytest.approx((low + high) / 2, abs=1e-4)


def test_rows_for_trees_are_dealt_by_their_number(spark, rows):
    """Files are cut by bytes, so a large split of few distinct values came to the trees in a few huge tasks."""
    few = spark.range(0, 1000, 1, 2)
    dealt = models.dealt_by_rows(few, 100)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10
    assert max(r["count"] for r in sizes) <= 110
    assert rows(dealt) == rows(few)
    assert models.dealt_by_rows(few, 500) is few


def test_trees_are_fitted_on_dealt_rows(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(models, "TREE_ROWS", 10, raising=False)
    monkeypatch.setattr(models, "demand_pipeline", lambda *_: type("Fit", (), {"fit": lambda _, rows: fitted.append(rows)})())
    split = spark.range(0, 50, 1, 2).select(
        *[F.col("id").alias(c) for c in [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]], F.lit("train").alias("split_name"), F.col("id").alias("qty_sold")
    )
    models.train_demand_model(split)
    assert fitted[0].rdd.getNumPartitions() == 5
    assert sorted(r["label"] for r in fitted[0].collect()) == [float(i) for i in range(50)]
