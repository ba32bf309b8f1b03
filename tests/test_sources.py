import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import fresh_dir
from shelfcast.sources import load, raw, tables


def test_align_rules(spark):
    df = spark.createDataFrame([("7", "x", "2024-01-05")], "a string, b string, c string")
    target = T.StructType([T.StructField(n, t) for n, t in [("a", T.LongType()), ("z", T.StringType()), ("n", T.DecimalType(5, 2)), ("m", T.DateType()), ("b", T.IntegerType())]])
    row = load.align(df, target, {"z": "b", "n": "-1.50", "m": "gone"}).first()
    assert (row["a"], row["z"], str(row["n"]), row["m"], row["b"]) == (7, "x", "-1.50", None, None)


def test_routes(spark):
    cases = {
        "mart/pos_events/sale_date=2026-05-01/part.parquet": ("sales_fact", "mart/pos_events", True, True),
        "mart/calendar_events/p.parquet": ("calendar_events", "mart/calendar_events", False, True),
        "mart/features/.spark-staging-f6be/feature_date=2026-05-19/p.parquet": ("features", "mart/features", True, False),
        "mart/features/_temporary/0/p.parquet": ("features", "mart/features", False, False),
        "functions/load.zip": (None, "functions", False, False),
        "pipelines/books.json": (None, "pipelines", False, False),
        "in/sns_mentions/mention_date=2026-01-01/p.parquet": (None, "in/sns_mentions", True, False),
    }
    df = spark.createDataFrame([(p,) for p in cases], "path string")
    got = {r["path"]: (r["target_table"], r["base_prefix"], r["is_partitioned"], r["is_loadable"]) for r in load.route_paths(df).collect()}
    assert got == cases
    only = load.route_paths(df, allowed=["features"]).filter("target_table IS NOT NULL").select("target_table").distinct()
    assert [r[0] for r in only.collect()] == ["features"]


def test_partition_writes(spark, rows):
    path = fresh_dir(spark, "t")
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(day, 1), (day + dt.timedelta(days=1), 2)], "d date, v int")
    tables.overwrite_partitions(df, path, "d", files_per_partition=2)
    tables.replace_partition(df.withColumn("v", F.lit(9)), path, "d", day)
    assert rows(spark.read.parquet(path), "d", "v") == [(day, 9), (day + dt.timedelta(days=1), 2)]
    tables.replace_partition(df.filter("v > 100"), path, "d", day)
    assert rows(spark.read.parquet(path), "v") == [(2,)]
    odd = spark.createDataFrame([("a=b/c d%", 1), (None, 2), ("x", 3)], "k string, v int")
    path = fresh_dir(spark, "odd")
    tables.overwrite_partitions(odd, path, "k")
    for value in ("a=b/c d%", None):
        tables.replace_partition(odd.withColumn("v", F.lit(7)), path, "k", value)
    read = spark.read.schema("v int, k string").parquet(path)
    assert rows(read, "k", "v") == sorted([("a=b/c d%", 7), (None, 7), ("x", 3)], key=repr)
    for value in ("a=b/c d%", None):
        tables.replace_partition(odd.limit(0), path, "k", value)
    assert rows(read.sparkSession.read.schema("v int, k string").parquet(path), "k", "v") == [("x", 3)]


def test_versions(spark, rows):
    base = fresh_dir(spark, "v")
    first = tables.publish_version(spark, spark.range(2), base)
    tables.publish_version(spark, spark.range(5), base, check=lambda df: df.count() == 5)
    with pytest.raises(ValueError):
        tables.publish_version(spark, spark.range(0), base, check=lambda df: df.count() > 0)
    assert tables.read_current(spark, base).count() == 5
    tables.select_version(spark, base, first)
    assert tables.read_current(spark, base).count() == 2


def test_typed_folders_skip_missing_ones(spark):
    base = fresh_dir(spark, "e")
    spark.createDataFrame([("1", "hall")], "event_id string, location string").write.json(f"{base}/book_fair")
    spark.createDataFrame([("2",)], "event_id string").write.json(f"{base}/holiday")
    df = raw.read_typed_folders(spark, base, ["book_fair", "holiday", "author_signing"], "event_id STRING, location STRING")
    assert {(r["event_id"], r["event_type"], r["location"]) for r in df.collect()} == {("1", "book_fair", "hall"), ("2", "holiday", None)}
    assert raw.read_typed_folders(spark, base, ["none"], "event_id STRING") is None


def test_hour_scan_reads_only_its_folders(spark):
    base = fresh_dir(spark, "h")
    rows = [(i, 2024, 1, 1, i) for i in range(6)]
    spark.createDataFrame(rows, "v int, year int, month int, day int, hour int").write.partitionBy("year", "month", "day", "hour").json(base)
    df = raw.read_recent_hours(spark, base, dt.datetime(2024, 1, 1, 4, 30), "v int, year int, month int, day int, hour int")
    assert sorted(r["v"] for r in df.collect()) == [3, 4]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_pushdown_and_pruning(spark):
    path = fresh_dir(spark, "p")
    spark.range(100).select("id", (F.col("id") * 2).alias("x"), F.lit("w").alias("y")).write.parquet(path)
    plan = spark.read.parquet(path).filter("id > 90").select("x")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,90)" in plan and "ReadSchema: struct<id:bigint,x:bigint>" in plan
