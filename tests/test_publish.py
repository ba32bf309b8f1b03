import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.plans import gates
from shelfcast.session import fresh_dir
from shelfcast.sources.tables import publish_audited, read_current

DAY = dt.date(2024, 1, 1)
LAST = DAY + dt.timedelta(days=9)
BOUNDS = {"min_rows": 20, "min_series": 3}


def panel(spark, series=3, days=10, missing=0):
    rows = [(f"b{s}", DAY + dt.timedelta(days=d), (s + d) % 3, None if s * days + d < missing else 1, 1, 0, 0, 0) for s in range(series) for d in range(days)]
    return spark.createDataFrame(rows, "isbn13 string, feature_date date, qty_sold int, day_of_week int, month int, holiday_flag int, weekend_flag int, bestseller_flag int")


def versions(spark, base):
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/data")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(place)]


def test_figures_of_the_write_equal_those_of_the_table(spark):
    base = fresh_dir(spark, "publish")
    done = gates.publish_training(panel(spark, missing=0), base, F.lit(LAST), F.lit(LAST), **BOUNDS).first()
    want = gates.training_metrics(read_current(spark, base), ["isbn13"]).first()
    assert {c: done[c] for c in want.asDict()} == want.asDict() and done["validation_status"] == "PASSED"


def test_nothing_is_published_on_failure_and_a_retry_is(spark):
    base = fresh_dir(spark, "refused")
    gates.publish_training(panel(spark), base, F.lit(LAST), F.lit(LAST), **BOUNDS)
    before = versions(spark, base)
    for bad in (panel(spark, missing=5), panel(spark, series=2), panel(spark).limit(0)):
        with pytest.raises(gates.GateError):
            gates.publish_training(bad, base, F.lit(LAST), F.lit(LAST), **BOUNDS)
    broken = panel(spark).withColumn("qty_sold", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        gates.publish_training(broken, base, F.lit(LAST), F.lit(LAST), **BOUNDS)
    assert versions(spark, base) == before and read_current(spark, base).count() == 30
    gates.publish_training(panel(spark, series=4), base, F.lit(LAST), F.lit(LAST), **BOUNDS)
    assert read_current(spark, base).count() == 40 and len(versions(spark, base)) == 2


def test_the_input_is_computed_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    df = panel(spark).mapInArrow(seen, panel(spark).schema)
    publish_audited(spark, df, fresh_dir(spark, "once"), {"n": F.count(F.lit(1))}, lambda audit: None)
    assert runs.value == 30
