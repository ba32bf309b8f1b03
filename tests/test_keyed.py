import random

from pyspark.sql import functions as F

from shelfcast.operators.keyed import dedupe_first, global_rank, latest_per_key, sorted_bijection
from shelfcast.sources import tables


def test_dedupe_first_is_repeatable_with_a_hot_key(spark):
    data = [("hot", i % 7, i) for i in range(1000)] + [(f"k{i}", 1, i) for i in range(500)]
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(7)
    got = {r["k"]: (r["o"], r["v"]) for r in dedupe_first(df, ["k"], ["o"]).collect()}
    assert len(got) == 501 and got["hot"] == (0, 0) and got["k9"] == (1, 9)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-02-01", 2), ("b", None, 3)], "k string, at string, v int")
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["at"]).collect()}
    assert got == {"a": 2, "b": 3}


def test_global_rank_does_not_depend_on_the_ranges(spark):
    """Keys of unequal length, negative numbers, texts and NULL; ordered as the key's own type is."""
    texts = [str(i) for i in range(1, 400)] + ["-5", "-40", "abc", "Z", "", None]
    for kind, keys in (("string", texts), ("bigint", [None, *range(-50, 350, 3)])):
        shuffled = keys[:]
        random.Random(1).shuffle(shuffled)
        df = spark.createDataFrame([(k,) for k in shuffled], f"k {kind}")
        order = sorted(keys, key=lambda k: (k is not None, k if k is not None else 0))
        want = {k: i + 1 for i, k in enumerate(order)}
        for splits in (1, 3, 16, None):
            ranked = global_rank(df, "k", splits=splits)
            assert ranked.columns == ["k", "rank_no"] and {r["k"]: r["rank_no"] for r in ranked.collect()} == want


def test_global_rank_matches_a_sort(spark):
    rng = random.Random(5)
    keys = sorted({f"978{rng.randrange(10**int(rng.choice([3, 6, 10]))):010d}" for _ in range(3000)})
    shuffled = keys[:]
    rng.shuffle(shuffled)
    ranked = global_rank(spark.createDataFrame([(k,) for k in shuffled], "k string"), "k", splits=16)
    assert {r["k"]: r["rank_no"] for r in ranked.collect()} == {k: i + 1 for i, k in enumerate(keys)}


def test_bijection_pairs_by_position(spark, rows):
    a = spark.createDataFrame([("0003",), ("0001",), ("0001",)], "x string")
    b = spark.createDataFrame([("0090",), ("0070",), ("0080",)], "y string")
    assert rows(sorted_bijection(a, b, "x", "y"), "x", "y") == [("0001", "0070"), ("0003", "0080")]


def test_insert_ignore_and_upsert_are_idempotent(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z")], "k int, v string")
    once = tables.insert_ignore(old, new, ["k"])
    assert rows(once) == [(1, "a"), (2, "b"), (3, "y")]
    assert rows(tables.insert_ignore(once, new, ["k"])) == rows(once)
    merged = tables.upsert(old, new, ["k"])
    assert rows(merged) == [(1, "a"), (2, "x"), (3, "y")]
    assert rows(tables.upsert(merged, new, ["k"])) == rows(merged)


def test_upsert_keeps_null_values_of_the_new_row(spark, rows):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(tables.upsert(old, new, ["k"])) == [(1, None)]


def test_upsert_resolves_copies_of_both_sides_in_one_shuffle(spark, rows):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (2, "c", 5), (None, "n", 1)], "k int, v string, t int")
    new = spark.createDataFrame([(2, 9, "x"), (2, 7, "z"), (None, 2, None), (4, 1, "y")], "k int, t int, v string")
    assert rows(tables.upsert(old, new, ["k"])) == [(1, "b", 0), (2, "z", 7), (4, "y", 1), (None, None, 2)]
    assert rows(tables.upsert(old, new, ["k"], ["t"])) == [(1, "b", 0), (2, "x", 9), (4, "y", 1), (None, None, 2)]
    assert rows(tables.upsert(old.select("k"), new.select("k"), ["k"])) == [(1,), (2,), (4,), (None,)]
    plan = tables.upsert(old, new, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "partial_max(" in plan


def test_plans_reduce_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dedupe_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(" in plan and "Window" not in plan
