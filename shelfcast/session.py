"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g", work_dir: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own. ``work_dir`` takes intermediate tables."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfcast")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in (SETTINGS | ({"spark.checkpoint.dir": work_dir} if work_dir else {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else one in the warehouse, which all executors reach too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; never reused, so runs cannot collide."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def join_path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts]) if "://" in base else os.path.join(base, *parts)


def through_disk(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors.

    The copy is removed when the session ends.
    """
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
