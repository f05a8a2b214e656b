"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording the Python call site of every column costs the driver more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Session with the settings the operators are tested under."""
    builder = SparkSession.builder.appName("marquee")
    if master:
        builder = builder.master(master).config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir. Only a session whose tasks run in the driver itself may
    do without, and then uses a folder beside the tables of its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/marquee/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends there."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
