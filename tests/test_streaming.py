import datetime as dt
import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.domain import locations_static
from shelfcast.session import fresh_dir
from shelfcast.streaming import pos, spikes

LINES = T.StructType([T.StructField("value", T.StringType())])


def record(i, **extra):
    return json.dumps({"tx_id": f"t{i}", "isbn13": "9780000000001", "qty": 2, "unit_price": 5, "total_price": 10, "channel": "online",
                       "location_id": 13, "ts": f"2024-01-01 {i % 24:02d}:00:00", **extra})


def land(spark, base, name, lines):
    spark.createDataFrame([(x,) for x in lines], LINES).coalesce(1).write.text(f"{base}/in/{name}")


STOCK = "isbn13 string, location_id bigint, on_hand bigint, reserved_qty bigint, safety_stock bigint"
ISBN = "9780000000001"


def opening(spark):
    return spark.createDataFrame([(ISBN, 15, 10, 1, 5), (ISBN, 13, 9, 0, 5)], STOCK)


def run(spark, base):
    tables = pos.PosTables(spark, f"{base}/tables")
    stream = pos.read_stream(spark, f"{base}/in", LINES, "text", files=1)
    pos.run_ingest(stream, tables, locations_static(spark), opening(spark)).awaitTermination()
    return tables


def sales_of(spark, lines):
    good, _ = pos.parse_records(spark.createDataFrame([(x,) for x in lines], LINES))
    return pos.sales_rows(good, locations_static(spark))


def test_every_transaction_once_over_batches_and_restarts(spark, rows):
    base = fresh_dir(spark, "ingest")
    land(spark, base, "a", [record(1), record(2), record(2, qty=1), "{broken"])
    land(spark, base, "b", [record(2), record(3, location_id=7), record(4, ts="never"), json.dumps({"tx_id": "t9"})])
    tables = run(spark, base)
    sales = tables.get("sales", pos.SALES_COLUMNS)
    assert [r[0] for r in rows(sales, "txn_id")] == ["t1", "t2", "t3"]
    assert {(r["txn_id"], r["wh_id"], r["debit_location_id"]) for r in sales.collect()} == {("t1", 1, 15), ("t2", 1, 15), ("t3", 2, 7)}
    bad = tables.get("rejected", "line string, reason string")
    assert [r[0] for r in rows(bad, "reason")] == ["bad_ts", "no_isbn13", "not_json"]
    assert tables.get("audit", "entity_id string").count() == 3

    before = rows(sales)
    run(spark, base)  # nothing new
    assert rows(tables.get("sales", pos.SALES_COLUMNS)) == before
    land(spark, base, "c", [record(1), record(2), record(5)])
    run(spark, base)
    assert [r[0] for r in rows(tables.get("sales", pos.SALES_COLUMNS), "txn_id")] == ["t1", "t2", "t3", "t5"]


def test_first_arrivals_take_no_python_and_the_earliest_copy(spark):
    base = fresh_dir(spark, "first")
    land(spark, base, "a", [record(1, ts="2024-01-01 05:00:00"), record(1, ts="2024-01-01 04:00:00", qty=3), record(1, ts="2024-01-01 04:00:00")])
    land(spark, base, "b", [record(1, ts="2024-01-01 01:00:00"), record(1, ts="2024-01-01 09:00:00"), record(2)])
    lines = pos.read_stream(spark, f"{base}/in", LINES, "text", files=1)
    made = pos.first_arrivals(pos.sales_rows(pos.parse_records(lines)[0], locations_static(spark)))
    assert "Pandas" not in made._jdf.queryExecution().analyzed().toString()
    got = {r["txn_id"]: (str(r["event_ts"]), r["qty"]) for r in run(spark, base).get("sales", pos.SALES_COLUMNS).collect()}
    assert got["t1"] == ("2024-01-01 04:00:00", 2) or got["t1"] == ("2024-01-01 01:00:00", 2)  # by the file that came first
    assert sorted(got) == ["t1", "t2"]


def test_repeated_batch_replaces_itself(spark):
    tables = pos.PosTables(spark, fresh_dir(spark, "repeat"))
    body = pos.ingest_batch(tables, opening(spark))
    first, second = sales_of(spark, [record(1), record(2)]), sales_of(spark, [record(3)])
    for batch, sales in [(0, first), (0, first), (1, second), (1, second)]:  # each again after a failure
        body(sales, batch)
    assert tables.get("sales", pos.SALES_COLUMNS).count() == 3
    left = {r["location_id"]: (r["on_hand"], r["taken"]) for r in pos.stock_now(tables, opening(spark)).collect()}
    assert left == {15: (4, 6), 13: (9, None)}
    (kpi,) = pos.newest(tables, "kpi", pos.KPI_COLUMNS, pos.KPI_KEYS).collect()
    assert (kpi["qty_sold"], kpi["revenue"], kpi["tx_count"], kpi["unique_isbn_count"], kpi["avg_price"]) == (6, 30, 3, 1, 5)


def test_stock_is_floored_where_it_stands_when_refilled(spark):
    tables = pos.PosTables(spark, fresh_dir(spark, "refill"))
    body = pos.ingest_batch(tables, opening(spark))
    body(sales_of(spark, [record(i) for i in range(6)]), 0)  # 12 of 10 units
    came = spark.createDataFrame([(ISBN, 15, 7)], "isbn13 string, location_id bigint, qty bigint")
    pos.restock(tables, opening(spark), came, after=0)
    pos.restock(tables, opening(spark), came, after=0)
    body(sales_of(spark, [record(7)]), 1)
    left = {r["location_id"]: r["on_hand"] for r in pos.stock_now(tables, opening(spark)).collect()}
    assert left == {15: 5, 13: 9}
    events = tables.get("stock_changed", pos.EVENT_COLUMNS + ", batch INT").orderBy("batch").collect()
    assert [(r["available"], r["cache_key"]) for r in events] == [(-1, f"stock:{ISBN}:15"), (4, f"stock:{ISBN}:15")]
    pos.compact(tables, "stock", pos.STOCK_COLUMNS, ["isbn13", "location_id"], 2)
    assert {r["location_id"]: r["on_hand"] for r in pos.stock_now(tables, opening(spark)).collect()} == left
    assert {r["batch"] for r in tables.get("stock", pos.STOCK_COLUMNS + ", batch INT").collect()} == {2}


def test_folding_the_stock_changes_nothing(spark):
    rng = random.Random(8)
    batches = [sales_of(spark, [record(10 * b + i, qty=rng.randrange(1, 4)) for i in range(2)]) for b in range(5)]
    came = spark.createDataFrame([(ISBN, 15, 2)], "isbn13 string, location_id bigint, qty bigint")
    tables = pos.PosTables(spark, fresh_dir(spark, "fold"))
    body = pos.ingest_batch(tables, opening(spark), fold=2)
    on_hand, taken = 10, 0
    for b, sales in enumerate(batches):
        for _ in range(1 + b // 3):  # the last two batches and deliveries are repeated
            body(sales, b)
        for _ in range(1 + b // 3):
            pos.restock(tables, opening(spark), came, after=b)
        sold = sales.agg(F.sum("qty")).first()[0]
        on_hand, taken = max(0, on_hand - sold) + 2, taken + sold
    left = {r["location_id"]: (r["on_hand"], r["taken"]) for r in pos.stock_now(tables, opening(spark)).collect()}
    assert left == {15: (on_hand, taken), 13: (9, None)}
    assert {r["batch"] for r in tables.get("stock", "batch INT").distinct().collect()} == {6, 7, 8, 9}


def test_one_day_is_written_by_several_tasks(spark):
    tables = pos.PosTables(spark, fresh_dir(spark, "salt"))
    rows = spark.range(1000).select("id", F.lit("2024-01-01").cast("date").alias("day"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows become one file again
    try:
        tables.put(rows, "t", 0, by="day")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(f"{tables.path('t')}/batch=0").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1


def test_stream_and_batch_agree_on_the_business_day(spark):
    tables = pos.PosTables(spark, fresh_dir(spark, "day"))
    late = sales_of(spark, [record(1, ts="2024-01-01 14:59:59"), record(2, ts="2024-01-01 15:00:00")])
    pos.ingest_batch(tables, opening(spark))(late, 0)
    kpi = {(str(r["kpi_date"]), r["qty_sold"]) for r in pos.newest(tables, "kpi", pos.KPI_COLUMNS, pos.KPI_KEYS).collect()}
    windows = pos.kpi_stream(late.select("event_ts", "store_id", "channel", "qty", "revenue")).collect()
    assert kpi == {(str(r["kpi_date"]), r["qty_sold"]) for r in windows} == {("2024-01-01", 2), ("2024-01-02", 2)}


def test_cooldown_inside_a_batch(spark):
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    events = sorted({(k, t0 + dt.timedelta(minutes=10 * rng.randrange(60))) for k in "ab" for _ in range(40)})
    kept, last = [], {}
    for k, at in events:
        if k not in last or last[k] <= at - dt.timedelta(minutes=30):
            kept.append((k, at))
            last[k] = at
    out = spikes.apply_cooldown(spark.createDataFrame(events, "isbn13 string, detected_at timestamp"))
    assert sorted((r["isbn13"], r["detected_at"]) for r in out.collect()) == kept


def test_cooldown_over_batches_reads_the_batch_before_only(spark):
    rng, t0 = random.Random(6), dt.datetime(2024, 1, 1)
    tables = pos.PosTables(spark, fresh_dir(spark, "cooling"))
    body = spikes.spike_batch(tables, threshold=1.0)
    at = [t0 + dt.timedelta(minutes=10 * i) for i in range(14)]
    hot = {t: set(rng.sample("abc", rng.randrange(0, 3))) for t in at}
    kept, last = [], {}
    for t in at:
        for k in sorted(hot[t]):
            if k not in last or last[k] <= t - dt.timedelta(minutes=30):
                kept.append((k, t))
                last[k] = t
    batches = [at[0:3], at[3:4], [], at[4:9], at[9:10], at[10:14]]
    for b, ends in enumerate(batches):
        rows = [(t - dt.timedelta(hours=1), t, k, 90 if k in hot[t] else 1) for t in ends for k in [*"abc", *(f"cold{i}" for i in range(9))]]
        counts = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, isbn13 string, count_w bigint")
        for _ in range(1 + (b == 3)):  # one batch is repeated
            body(counts, b)
        cooling = tables.get_batch("cooling", spikes.RECENT_COLUMNS, b).collect()
        assert len(cooling) <= 3 and all(r["detected_at"] > max(x for e in batches[: b + 1] for x in e) - dt.timedelta(minutes=30) for r in cooling)
    stored = tables.get("spikes", spikes.SPIKE_COLUMNS).collect()
    assert sorted((r["isbn13"], r["detected_at"]) for r in stored) == sorted(kept)
    assert {r["batch"] for r in tables.get("cooling", "batch INT").collect()} <= {4, 5}


def test_spike_stream_equals_batch(spark):
    base = fresh_dir(spark, "spike")
    t0 = dt.datetime(2024, 1, 1)
    sales = [(f"b{i % 12}", t0 + dt.timedelta(minutes=5 * i)) for i in range(280)] + [("hot", t0 + dt.timedelta(minutes=300 + i)) for i in range(60)]
    sales.append(("late", t0 + dt.timedelta(days=3)))
    spark.createDataFrame(sales, "isbn13 string, event_ts timestamp").write.parquet(f"{base}/in")
    tables = pos.PosTables(spark, f"{base}/tables")
    stream = pos.read_stream(spark, f"{base}/in", T.StructType.fromDDL("isbn13 STRING, event_ts TIMESTAMP"), "parquet")
    spikes.run_spikes(stream, tables).awaitTermination()
    stored = tables.get("spikes", spikes.SPIKE_COLUMNS)
    counts = spikes.sales_windows(spark.read.parquet(f"{base}/in")).filter(F.col("window_end") < t0 + dt.timedelta(days=2))
    none = spark.createDataFrame([], "isbn13 string, detected_at timestamp")
    want = spikes.new_spikes(spikes.window_zscores(counts), none)
    key = lambda df: sorted((r["isbn13"], r["detected_at"], r["severity"]) for r in df.collect())
    assert key(stored) == key(want) and {r["isbn13"] for r in stored.collect()} >= {"hot"}
    assert tables.get("spike_audit", "action string").count() == stored.count()


def test_archive_splits_bad_lines(spark):
    base = fresh_dir(spark, "archive")
    land(spark, base, "a", [record(1), "junk"])
    stream = pos.read_stream(spark, f"{base}/in", LINES, "text")
    at = F.expr("try_cast(get_json_object(value, '$.ts') AS timestamp)")
    pos.archive(stream, f"{base}/out", f"{base}/cp", at).awaitTermination()
    good = spark.read.text(f"{base}/out/data")
    assert good.select("year", "month", "day").first()[:] == (2024, 1, 1) and good.count() == 1
    assert [r["value"] for r in spark.read.text(f"{base}/out/errors").collect()] == ["junk"]


def test_spike_batch_runs_through_the_closed_windows_once(spark):
    tables = pos.PosTables(spark, fresh_dir(spark, "once"))
    t0, seen = dt.datetime(2024, 1, 1), spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(t0, t0 + dt.timedelta(hours=1), f"b{i}", 90 if i == 0 else 1) for i in range(10)]
    counts = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, isbn13 string, count_w bigint")
    spikes.spike_batch(tables)(counts.mapInArrow(passed, counts.schema), 0)
    assert [r["isbn13"] for r in tables.get("spikes", spikes.SPIKE_COLUMNS).collect()] == ["b0"]
    assert seen.value == len(rows) and tables.get_batch("closed", spikes.CLOSED_COLUMNS, 0).isEmpty()


def test_spike_stream_keeps_its_state_in_rocksdb(spark):
    base, name = fresh_dir(spark, "spike-state"), "spark.sql.streaming.stateStore.providerClass"
    spark.conf.unset(name)
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1))], "isbn13 string, event_ts timestamp").write.parquet(f"{base}/in")
    stream = pos.read_stream(spark, f"{base}/in", T.StructType.fromDDL("isbn13 STRING, event_ts TIMESTAMP"), "parquet")
    query = spikes.run_spikes(stream, pos.PosTables(spark, f"{base}/tables"))
    query.awaitTermination()
    assert any("rocksdbPutCount" in s["customMetrics"] for p in query.recentProgress for s in p["stateOperators"])


def test_window_scores_do_not_depend_on_the_order_of_rows(spark):
    rng, t0 = random.Random(8), dt.datetime(2024, 1, 1)
    rows = [(t0, t0 + dt.timedelta(hours=1), f"b{i}", 90 if i < 7 else i % 5) for i in range(300)]
    seen = set()
    for parts in (1, 3, 7, 8):
        rng.shuffle(rows)
        counts = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "window_start timestamp, window_end timestamp, isbn13 string, count_w bigint")
        seen |= {(r["mean_w"], r["std_w"], r["z_score"]) for r in spikes.window_zscores(counts).filter("count_w = 90").collect()}
    assert len(seen) == 1
    at_three = [(t0, t0 + dt.timedelta(hours=1), f"b{i}", 2 if i == 0 else 1) for i in range(10)]  # mean 1.1, spread 0.3
    counts = spark.createDataFrame(at_three, "window_start timestamp, window_end timestamp, isbn13 string, count_w bigint")
    assert [r["z_score"] for r in spikes.window_zscores(counts, threshold=3.0).collect()] == [3.0]
