"""Spike detection on mention and sales streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.enrich import without_recent
from shelfcast.streaming.pos import audit_rows


def mention_windows(mentions: DataFrame, at: str = "collected_at", width: str = "2 hours", slide: str = "1 hour", delay: str = "1 hour", measure: str = "records") -> DataFrame:
    """Mentions per book in windows of the current and the previous hour."""
    size = F.count("*") if measure == "records" else F.sum("mention_count")
    return (
        mentions.withWatermark(at, delay)
        .groupBy(F.window(at, width, slide).alias("w"), "isbn13")
        .agg(size.alias("mentions_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "isbn13", "mentions_count")
    )


def poisson_score(windows: DataFrame, default_baseline: float = 5.0, threshold: float = 3.0) -> DataFrame:
    """z-score against a Poisson baseline and a first order quantity; works on streams too."""
    base = F.coalesce("baseline_lam", F.lit(default_baseline)) if "baseline_lam" in windows.columns else F.lit(default_baseline)
    z = F.when(base > 0, (F.col("mentions_count") - base) / F.sqrt(base)).otherwise(F.lit(0.0))
    scored = windows.withColumn("_z", z).filter(F.col("_z") >= threshold).withColumn("z_score", F.bround("_z", 2)).drop("_z")
    return scored.withColumn("predicted_qty", F.least(F.lit(400), F.greatest(F.lit(30), F.bround(F.col("z_score") * 30).cast("int"))))


def window_zscores(counts: DataFrame, threshold: float = 2.0, salts: int = 16) -> DataFrame:
    """Books that stand out from all books of the same window.

    Mean and spread are aggregated per window, reduced on the map side, from sums of whole numbers, so that the order of the
    rows does not show in scores at a threshold. They are joined back over a salt, so the books of one window meet them in
    ``salts`` tasks.
    """
    keys = ["window_start", "window_end"]
    n, total, squares = (F.col(c).cast("decimal(38,0)") for c in ("_n", "_sum", "_squares"))
    sums = counts.groupBy(*keys).agg(
        F.count("count_w").alias("_n"), F.sum("count_w").alias("_sum"), F.sum(F.col("count_w") * F.col("count_w")).alias("_squares")
    )
    root = F.sqrt((n * squares - total * total).cast("double"))  # n times the spread
    stats = sums.withColumn("_root", root).filter("_root > 0").withColumns(
        {"mean_w": F.col("_sum").cast("double") / F.col("_n"), "std_w": F.col("_root") / F.col("_n")}
    ).drop("_squares")
    spread = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64("isbn13"), F.lit(salts)).cast("int"))
    z = (F.col("count_w") * F.col("_n") - F.col("_sum")).cast("double") / F.col("_root")
    scored = salted.join(spread, [*keys, "_salt"]).withColumn("z_score", z).filter(F.col("z_score") >= threshold)
    return scored.drop("_salt", "_n", "_sum", "_root")


def severity(z: str = "z_score"):
    return F.when(F.col(z) >= 3.0, "CRITICAL").otherwise("WARNING")


def sales_windows(sales: DataFrame, at: str = "event_ts", width: str = "60 minutes", slide: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    return (
        sales.withWatermark(at, delay)
        .groupBy(F.window(at, width, slide).alias("w"), "isbn13")
        .agg(F.count("*").alias("count_w"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "isbn13", "count_w")
    )


def apply_cooldown(candidates: DataFrame, key: str = "isbn13", at: str = "detected_at", minutes: int = 30) -> DataFrame:
    """Keep a candidate only if no kept one of the same key lies in the minutes before it.

    Whether a candidate counts depends on the ones kept before it, so the times
    of a key are folded in order. A key has at most one candidate per window,
    which bounds the folded list by the number of windows, not by raw rows.
    """
    gap = F.expr(f"INTERVAL {minutes} MINUTES")
    times = candidates.groupBy(key).agg(F.array_sort(F.collect_set(at)).alias("_times"))

    def step(kept, t):
        newest = F.element_at(kept, -1)
        return F.when((F.size(kept) > 0) & (newest > t - gap), kept).otherwise(F.concat(kept, F.array(t)))

    none = F.array().cast("array<timestamp>")
    kept = times.select(key, F.explode(F.aggregate("_times", none, step)).alias(at))
    return candidates.join(kept, [key, at])


def new_spikes(windows: DataFrame, history: DataFrame, minutes: int = 30) -> DataFrame:
    """Spikes of the scored windows: outside the cooldown of stored ones and of each other."""
    marked = windows.withColumn("detected_at", F.col("window_end")).withColumn("severity", severity())
    return apply_cooldown(without_recent(marked, history, "isbn13", "detected_at", minutes), minutes=minutes)


SPIKE_COLUMNS = "isbn13 STRING, detected_at TIMESTAMP, z_score DOUBLE, count_w BIGINT, severity STRING"


RECENT_COLUMNS = "isbn13 STRING, detected_at TIMESTAMP"


CLOSED_COLUMNS = "window_start TIMESTAMP, window_end TIMESTAMP, isbn13 STRING, count_w BIGINT"


def still_cooling(recent: DataFrame, closed: DataFrame, minutes: int) -> DataFrame:
    """The newest spike of every book that can still hold back one of a later batch.

    Later batches only close windows that end after all ``closed`` so far, so a spike older than the cooldown before
    the newest of them is dropped: what is kept is bounded by the books that spiked within one cooldown.
    """
    newest = closed.agg(F.max("window_end").alias("_end"))
    last = recent.groupBy("isbn13").agg(F.max("detected_at").alias("detected_at"))
    cooling = F.col("_end").isNull() | (F.col("detected_at") > F.col("_end") - F.expr(f"INTERVAL {minutes} MINUTES"))
    return last.join(F.broadcast(newest), cooling).drop("_end")  # one row, so no row meets more than one


def spike_batch(tables, threshold: float = 2.0, minutes: int = 30):
    """``foreachBatch`` body: score closed windows, keep new spikes, log them, hand on the cooldowns that still run.

    A batch reads the running cooldowns of the batch before it and no older spike, and writes its own. Batch numbers have
    no gaps, and a repeated batch reads the same cooldowns again and replaces what it wrote. The closed windows are written
    first and read back, since each further use of a stream's batch would run through its whole state once more.
    """

    def body(batch_counts: DataFrame, batch: int) -> None:
        columns = [c.split(" ") for c in CLOSED_COLUMNS.split(", ")]
        tables.put(batch_counts.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns]), "closed", batch)
        counts = tables.get_batch("closed", CLOSED_COLUMNS, batch)
        recent = tables.get_batch("cooling", RECENT_COLUMNS, batch - 1)
        found = new_spikes(window_zscores(counts, threshold), recent, minutes)
        tables.put(found.select(*[c.split(" ")[0] for c in SPIKE_COLUMNS.split(", ")]), "spikes", batch)
        stored = tables.get_batch("spikes", SPIKE_COLUMNS, batch)
        tables.put(still_cooling(recent.unionByName(stored.select("isbn13", "detected_at")), counts, minutes), "cooling", batch)
        tables.drop_batch("cooling", batch - 2)
        tables.drop_batch("closed", batch)
        named = stored.withColumn("event_id", F.concat_ws("@", "isbn13", F.col("detected_at").cast("string")))
        tables.put(audit_rows(named, "spike-stream", "spike.detected", "spike_events", "event_id", ["isbn13", "z_score", "count_w", "severity"]), "spike_audit", batch)

    return body


def run_spikes(sales: DataFrame, tables, threshold: float = 2.0, once: bool = True, **windows):
    """Sliding sales counts per book, scored when a window closes.

    The counts of open windows are kept in a RocksDB state store: a sale is in as many windows as slides fit into one.
    """
    tables.spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    writer = sales_windows(sales, **windows).writeStream.outputMode("append").foreachBatch(spike_batch(tables, threshold))
    writer = writer.option("checkpointLocation", tables.path("_spike_checkpoint"))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 minutes")
    return writer.start()
