"""Point-of-sale stream: ingest once, keep KPIs and stock current, archive raw records.

State lives in parquet tables written per batch. Every batch writes under its
own batch number, so a batch that is repeated after a failure replaces its own
output instead of adding to it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.columns import business_date
from shelfcast.operators.cleanse import normalize_pos, stream_warehouse
from shelfcast.operators.enrich import stock_location
from shelfcast.operators.rollups import kpi_of_books
from shelfcast.session import through_disk
from shelfcast.sources.raw import POS_SCHEMA


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files: int = 10, **options) -> DataFrame:
    """Files as a stream, a bounded number per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true")
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.format(fmt).load(path)


def read_kafka(spark: SparkSession, servers: str, topic: str, records: int | None = None) -> DataFrame:
    """The same feed from a broker topic keyed by book; needs the Kafka package on the cluster.

    ``records`` bounds a batch; without it a batch takes what has come.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if records is not None:
        reader = reader.option("maxOffsetsPerTrigger", records)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def parse_records(lines: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split JSON lines into usable records and rejected lines with a reason."""
    schema = T.StructType([*POS_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.select(
        F.col(text).alias("line"),
        F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"),
    )
    reason = (
        F.when(F.col("r").isNull() | F.col("r._bad").isNotNull(), "not_json")
        .when(F.col("r.tx_id").isNull(), "no_tx_id")
        .when(F.col("r.isbn13").isNull(), "no_isbn13")
        .when(F.col("r.qty").isNull(), "no_qty")
        .when(F.col("r.location_id").isNull(), "no_location_id")
        .when(F.expr("try_cast(r.ts AS timestamp)").isNull(), "bad_ts")
    )
    marked = parsed.withColumn("reason", reason)
    good = marked.filter(F.col("reason").isNull()).select(*[F.col(f"r.{f.name}").alias(f.name) for f in POS_SCHEMA.fields])
    return good, marked.filter(F.col("reason").isNotNull()).select("line", "reason")


def sales_rows(records: DataFrame, locations: DataFrame) -> DataFrame:
    """Normalized sales rows with the warehouse of their store, their business date and the place they are debited from."""
    rows = normalize_pos(records).withColumns(stream_warehouse()).withColumn("kpi_date", business_date("event_ts"))
    return stock_location(rows, locations)


def debit(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Stock after the sales: debits are added up per book and place, then floored at 0 once."""
    taken = sales.groupBy("isbn13", F.col("debit_location_id").alias("location_id")).agg(F.sum("qty").alias("taken"))
    return inventory.join(taken, ["isbn13", "location_id"], "left").withColumn(
        "on_hand", F.greatest(F.col("on_hand") - F.coalesce("taken", F.lit(0)), F.lit(0))
    )


def stock_events(stock: DataFrame) -> DataFrame:
    """One message per stock row: what is left to sell and the cache key to drop."""
    return stock.select(
        "isbn13", "location_id", (F.col("on_hand") - F.col("reserved_qty")).alias("available"),
        F.concat_ws(":", F.lit("stock"), "isbn13", F.col("location_id").cast("string")).alias("cache_key"),
    )


def audit_rows(rows: DataFrame, actor: str, action: str, entity: str, key: str, state: list[str]) -> DataFrame:
    """Change log rows with the state after the change as JSON text."""
    return rows.select(
        F.lit(actor).alias("actor_id"), F.lit(action).alias("action"), F.lit(entity).alias("entity_type"),
        F.col(key).alias("entity_id"), F.to_json(F.struct(*state)).alias("after_state"),
    )


class PosTables:
    """Folders one point-of-sale stream writes to."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def put(self, df: DataFrame, name: str, batch: int, by: str | None = None, files: int = 8) -> None:
        """Write one batch of a table; repeating the batch replaces it. A value of ``by`` is spread over ``files`` tasks."""
        writer = df.write
        if by is not None:
            salt = F.pmod(F.xxhash64(*df.columns), F.lit(files))
            writer = df.withColumn("_salt", salt).repartition(by, "_salt").drop("_salt").write.partitionBy(by)
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path(name)}/batch={batch}")

    def get(self, name: str, schema: str) -> DataFrame:
        """The named columns of all batches so far; ``batch INT`` may be one. An absent table is empty."""
        return self._read(self.path(name), schema)

    def get_batch(self, name: str, schema: str, batch: int) -> DataFrame:
        """The named columns of one batch; a batch that was not written is empty."""
        return self._read(f"{self.path(name)}/batch={batch}", schema)

    def drop_batch(self, name: str, batch: int) -> None:
        """Remove what one batch wrote, if it wrote anything."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/batch={batch}")
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    def _read(self, path: str, schema: str) -> DataFrame:
        names = T.StructType.fromDDL(schema).names
        reader = self.spark.read.schema(schema).option("ignoreMissingFiles", "true")
        try:
            return reader.parquet(path).select(*names)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


SALES_COLUMNS = (
    "txn_id STRING, event_ts TIMESTAMP, store_id BIGINT, wh_id BIGINT, channel STRING, isbn13 STRING, qty BIGINT, "
    "unit_price BIGINT, discount BIGINT, revenue BIGINT, payment_method STRING, kpi_date DATE, debit_location_id BIGINT"
)
KPI_KEYS = ["kpi_date", "store_id", "channel"]
BOOK_COLUMNS = "kpi_date DATE, store_id BIGINT, channel STRING, isbn13 STRING, q BIGINT, r BIGINT, n BIGINT"
KPI_COLUMNS = (
    "kpi_date DATE, store_id BIGINT, channel STRING, qty_sold BIGINT, revenue BIGINT, tx_count BIGINT, unique_isbn_count BIGINT, "
    "top_isbn STRING, avg_price BIGINT"
)
STOCK_COLUMNS = "isbn13 STRING, location_id BIGINT, on_hand BIGINT, reserved_qty BIGINT, safety_stock BIGINT, taken BIGINT"
EVENT_COLUMNS = "isbn13 STRING, location_id BIGINT, available BIGINT, cache_key STRING"


def names_of(schema: str) -> list[str]:
    return T.StructType.fromDDL(schema).names


def newest(tables: PosTables, name: str, schema: str, keys: list[str], before: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """The last written row of every key, or of the keys in ``among``, of all batches or of those before one."""
    rows = tables.get(name, schema + ", batch INT")
    rows = rows if among is None else rows.join(among, keys, "left_semi")
    rows = rows if before is None else rows.filter(F.col("batch") < before)
    rest = [c for c in names_of(schema) if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in names_of(schema)])


# Stock rows carry a step instead of a batch number: batch b of the sales is step 2b, what happens after it is step 2b + 1.


def stock_now(tables: PosTables, opening: DataFrame, before: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """Current stock, of all or of the books and places in ``among``: the last written row, else the opening one."""
    keys = ["isbn13", "location_id"]
    written = newest(tables, "stock", STOCK_COLUMNS, keys, before, among)
    opening = opening if among is None else opening.join(among, keys, "left_semi")
    first = opening.withColumn("taken", F.lit(None).cast("bigint")).select(*names_of(STOCK_COLUMNS))
    return written.unionByName(first.join(written.select(*keys), keys, "left_anti"))


def restock(tables: PosTables, opening: DataFrame, deliveries: DataFrame, after: int) -> None:
    """Add delivered units (isbn13, location_id, qty) to the stock as it stands after a batch; repeating it changes nothing."""
    step = 2 * after + 1
    came = deliveries.groupBy("isbn13", "location_id").agg(F.sum("qty").alias("_came"))
    rows = stock_now(tables, opening, step, came).join(came, ["isbn13", "location_id"]).withColumn("on_hand", F.col("on_hand") + F.col("_came"))
    tables.put(rows.select(*names_of(STOCK_COLUMNS)), "stock", step)


def first_arrivals(sales: DataFrame) -> DataFrame:
    """Of every transaction the first row that ever arrived; among copies of one batch the earliest, then the smallest.

    The transactions seen are state of a streaming aggregation, read by a query in update mode; so a batch costs what it
    holds, however long the history, and no row passes through Python. The state keeps the first row with the time of its
    batch, which Spark logs, so that a repeated batch has the same. A row leaves only if its transaction has been seen at
    no other time than the present batch's; so a clock that is set back lets no transaction through twice.
    """
    now = F.current_timestamp()
    rest = [c for c in sales.columns if c not in ("txn_id", "event_ts")]
    seen = sales.withColumn("_at", now).groupBy("txn_id").agg(
        F.min(F.struct("_at", "event_ts", *rest)).alias("_first"), F.max("_at").alias("_last")
    )
    fresh = seen.filter((F.col("_first._at") == now) & (F.col("_last") == now))
    return fresh.select(*[F.col(c) if c == "txn_id" else F.col(f"_first.{c}").alias(c) for c in sales.columns])


def ingest_batch(tables: PosTables, opening: DataFrame, fold: int = 50):
    """``foreachBatch`` body for first arrivals: sales, KPIs of the touched days, stock, stock messages and change log.

    Everything is written under the batch number and computed from what was written before it, so a repeated batch
    replaces its own rows. Every ``fold`` batches the stock rows of older batches become one per book and place: a batch
    reads the stock as it stands and the rows of ``fold`` batches, however long the history.
    """

    def body(sales: DataFrame, batch: int) -> None:
        if batch and batch % fold == 0:
            # Not the step of a delivery after the last batch: that one may still be repeated.
            compact(tables, "stock", STOCK_COLUMNS, ["isbn13", "location_id"], 2 * (batch - 1))
        tables.put(sales.select(*names_of(SALES_COLUMNS)), "sales", batch, by="kpi_date")
        stored = tables.spark.read.schema(SALES_COLUMNS).parquet(f"{tables.path('sales')}/batch={batch}")
        books = stored.groupBy(*KPI_KEYS, "isbn13").agg(F.sum("qty").alias("q"), F.sum("revenue").alias("r"), F.count("*").alias("n"))
        tables.put(books, "kpi_books", batch, by="kpi_date")
        known = tables.get("kpi_books", BOOK_COLUMNS + ", batch INT").filter(F.col("batch") <= batch)
        touched = known.join(stored.select(*KPI_KEYS).distinct(), KPI_KEYS, "left_semi")
        tables.put(kpi_of_books(touched).select(*names_of(KPI_COLUMNS)), "kpi", batch)
        taken = stored.groupBy("isbn13", F.col("debit_location_id").alias("location_id")).agg(F.sum("qty").alias("_now"))
        before = stock_now(tables, opening, 2 * batch, taken).join(taken, ["isbn13", "location_id"])
        after = before.withColumns(
            {"on_hand": F.greatest(F.col("on_hand") - F.col("_now"), F.lit(0)), "taken": F.coalesce("taken", F.lit(0)) + F.col("_now")}
        )
        tables.put(after.select(*names_of(STOCK_COLUMNS)), "stock", 2 * batch)
        changed = tables.spark.read.schema(STOCK_COLUMNS).parquet(f"{tables.path('stock')}/batch={2 * batch}")
        tables.put(stock_events(changed), "stock_changed", batch)
        tables.put(audit_rows(stored, "pos-stream", "sales.ingest", "sales_realtime", "txn_id", ["isbn13", "store_id", "qty"]), "audit", batch)

    return body


def compact(tables: PosTables, name: str, schema: str, keys: list[str], upto: int) -> None:
    """Fold the batches up to one into a single batch that holds the last row of every key; later batches stay.

    The folded rows are added to batch ``upto`` before the older folders are removed, so a reader never misses a row. Where
    that batch has a key already, the folded row is equal to it; so folding can be cut off anywhere and repeated.
    """
    spark = tables.spark
    folded = through_disk(spark, newest(tables, name, schema, keys, upto + 1), f"compact-{name}")
    folded.write.mode("append").parquet(f"{tables.path(name)}/batch={upto}")
    place = spark._jvm.org.apache.hadoop.fs.Path(tables.path(name))
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(place):
        number = status.getPath().getName().partition("batch=")[2]
        if number.isdigit() and int(number) < upto:
            files.delete(status.getPath(), True)


class Running:
    """The queries of one ingest: the sales and the rejected lines."""

    def __init__(self, queries):
        self.queries = queries

    def awaitTermination(self) -> None:  # noqa: N802  as a single query has it
        for query in self.queries:
            query.awaitTermination()


def run_ingest(lines: DataFrame, tables: PosTables, locations: DataFrame, opening: DataFrame, once: bool = True) -> Running:
    """Start the ingest: everything available once, or every five seconds.

    The transactions seen are kept in a RocksDB state store. The checkpoints live with the tables, because their batch numbers belong
    together.
    """
    tables.spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    good, bad = parse_records(lines)
    sales = first_arrivals(sales_rows(good, locations).select(*names_of(SALES_COLUMNS)))
    timing = {"availableNow": True} if once else {"processingTime": "5 seconds"}
    writers = [
        sales.writeStream.outputMode("update").foreachBatch(ingest_batch(tables, opening)).option("checkpointLocation", tables.path("_checkpoint")),
        bad.writeStream.foreachBatch(lambda rows, batch: tables.put(rows, "rejected", batch)).option("checkpointLocation", tables.path("_checkpoint_bad")),
    ]
    return Running([w.trigger(**timing).start() for w in writers])


def dedupe_stream(records: DataFrame, key: str = "tx_id", at: str = "event_ts", delay: str = "24 hours") -> DataFrame:
    """Stateful variant: copies of a transaction inside the retention period are dropped."""
    return records.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def kpi_stream(records: DataFrame, at: str = "event_ts", delay: str = "1 day") -> DataFrame:
    """Running totals per business day, store and channel over an already deduplicated stream.

    A business day begins at midnight in the business time zone, 15:00 UTC the day before.
    """
    return (
        records.withWatermark(at, delay)
        .groupBy(F.window(at, "1 day", startTime="15 hours").alias("w"), "store_id", "channel")
        .agg(F.sum("qty").alias("qty_sold"), F.sum("revenue").alias("revenue"), F.count("*").alias("tx_count"))
        .select(business_date("w.start").alias("kpi_date"), "store_id", "channel", "qty_sold", "revenue", "tx_count")
    )


def archive(lines: DataFrame, path: str, checkpoint: str, at: Column, once: bool = True):
    """Raw lines as gzip text by year, month and day; unusable lines go to an error folder."""

    def body(batch_lines: DataFrame, batch: int) -> None:
        stamped = batch_lines.withColumn("_at", at)
        parts = {"year": F.date_format("_at", "yyyy"), "month": F.date_format("_at", "MM"), "day": F.date_format("_at", "dd")}
        good = stamped.filter(F.col("_at").isNotNull()).withColumns(parts)
        good.select("value", *parts).write.mode("overwrite").option("compression", "gzip").partitionBy(*parts).text(f"{path}/data/batch={batch}")
        bad = stamped.filter(F.col("_at").isNull()).select("value")
        bad.write.mode("overwrite").option("compression", "gzip").text(f"{path}/errors/batch={batch}")

    writer = lines.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")
    return writer.start()


def mirror(spark: SparkSession, source: str, target: str, schema: T.StructType, checkpoint: str, by: list[str] = ()):
    """Copy new mart files onward, each exactly once."""
    writer = spark.readStream.schema(schema).parquet(source).writeStream.format("parquet")
    if by:
        writer = writer.partitionBy(*by)
    return writer.option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
