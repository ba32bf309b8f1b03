"""One key holds a third of the rows: results stay whole and no task gets the whole key."""

from pyspark.sql import functions as F

from shelfcast.domain import locations_static
from shelfcast.operators import enrich, rollups
from shelfcast.operators.keyed import dedupe_first
from shelfcast.operators.quantiles import exact_quantiles
from shelfcast.session import fresh_dir


def skewed(spark, n=60_000):
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("isbn13"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("sale_date"),
        (F.col("id") % 14 + 1).alias("store_id"), F.lit("offline").alias("channel"), (F.col("id") % 5).alias("qty"),
        (F.col("id") % 1000).alias("revenue"), F.col("id"),
    )




def test_totals_stay_whole(spark):
    df = skewed(spark)
    kpi = rollups.kpi_daily(df)
    assert kpi.agg(F.sum("tx_count")).first()[0] == 60_000
    assert kpi.agg(F.sum("qty_sold")).first()[0] == df.agg(F.sum("qty")).first()[0]
    assert dedupe_first(df, ["isbn13"], ["id"]).count() == df.select("isbn13").distinct().count()


def test_copies_leave_before_the_shuffle(spark):
    plan = dedupe_first(skewed(spark), ["isbn13"], ["id"])
    plan.collect()
    moved = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(" in moved.split("Exchange")[-1]


def test_hot_group_quantile(spark):
    df = skewed(spark).withColumn("v", F.sqrt(F.col("id").cast("double")))
    got = {r["isbn13"]: r["q"] for r in exact_quantiles(df, ["isbn13"], "v", {"q": 0.9}, cuts=32).collect()}
    want = {r["isbn13"]: r["q"] for r in df.groupBy("isbn13").agg(F.expr("percentile(v, 0.9)").alias("q")).collect()}
    assert len(got) == len(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_stock_is_not_sent_to_every_task(spark):
    place = F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(1, 17)])).alias("location_id")
    path = f"{fresh_dir(spark, 'stock')}/stock"
    spark.range(30_000).select(F.col("id").alias("n")).write.parquet(path)  # few bytes on disk, many rows of stock
    stock = spark.read.parquet(path).select(F.col("n").cast("string").alias("isbn13"), place).selectExpr("*", "9L AS on_hand", "2L AS reserved_qty")
    out = enrich.online_available(stock, locations_static(spark))
    assert out.agg(F.sum("available")).first()[0] == 30_000 * 2 * 7
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BuildRight" in plan and "BuildLeft" not in plan


def test_stock_summary_deals_rows_before_it_groups(spark):
    stock = [(1, "a", 3), (1, "a", 4), (1, None, 5), (1, "b", None), (2, "a", 1)]
    summary = rollups.branch_inventory(spark.createDataFrame(stock, "location_id bigint, isbn13 string, on_hand bigint"), locations_static(spark))
    plan = summary._jdf.queryExecution().executedPlan().toString()
    got = {r["location_id"]: (r["distinct_books"], r["total_qty"]) for r in summary.collect()}
    assert len(got) == locations_static(spark).count() and got[1] == (2, 12) and got[2] == (1, 1) and got[3] == (0, None)
    assert f", {rollups.DEALT_PARTS}), REPARTITION_BY_NUM" in plan and "Aggregate" not in plan.split("REPARTITION_BY_NUM")[1]
