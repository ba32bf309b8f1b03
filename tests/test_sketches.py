import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators.quantiles import exact_quantiles
from shelfcast.operators.sketches import merged_quantiles, rank_error, sketch_by

QS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


@pytest.mark.parametrize("kind", ["uniform", "heavy tail", "one day holds a third"])
def test_merged_days_are_within_the_rank_error(spark, kind):
    rng = np.random.default_rng(5)
    values = np.exp(rng.normal(0, 4, 30_000)) if kind == "heavy tail" else rng.random(30_000)
    days = np.where(rng.random(30_000) < 0.33, 3, rng.integers(0, 12, 30_000)) if kind == "one day holds a third" else rng.integers(0, 12, 30_000)
    df = spark.createDataFrame([("m", int(d), float(v)) for d, v in zip(days, values)], "model string, day int, v double")
    stored = sketch_by(df, ["model", "day"], "v", k=400)
    for among, part in [(None, values), (F.col("day") < 5, values[days < 5])]:
        got = merged_quantiles(stored, ["model"], QS, among).first()
        assert got["n"] == len(part)
        for name, q in QS.items():
            assert abs((part <= got[name]).mean() - q) <= 2 * rank_error(400)  # room for the rare miss


def test_few_values_are_exact_and_nulls_do_not_count(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("a", 2, None), ("a", 3, 6.0), ("b", 1, None)], "g string, day int, v double")
    stored = sketch_by(df, ["g", "day"], "v")
    assert stored.count() == 3
    (row,) = merged_quantiles(stored, ["g"], {"mid": 0.5}).collect()
    assert (row["g"], row["n"], row["mid"]) == ("a", 3, exact_quantiles(df, ["g"], "v", {"mid": 0.5}).filter("g = 'a'").first()["mid"])
    assert merged_quantiles(stored, ["g"], QS, F.col("day") > 9).collect() == []


def test_days_are_sketched_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("day"), F.rand(1).alias("v"))
    plan = merged_quantiles(sketch_by(df, ["day"], "v"), [], QS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_kll_sketch_agg_double") == 1 and plan.index("Exchange") < plan.index("partial_kll_sketch_agg_double")
