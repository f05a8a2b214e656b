"""Bronze ingestion as a file stream that picks up each landed file once and then stops.

A batch carries the stream's id and its own number, and the table remembers the last number of each stream: a batch that
is sent again, after a failure between its commit and the stream's, adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.contracts import FEEDS, RAW_SCHEMAS
from marquee.sources.landing import CORRUPT
from marquee.sources.layers import append_bronze


def landed_stream(spark: SparkSession, base: str, feed: str, source: str) -> DataFrame:
    """New landed records with lineage; the day comes from the folder name."""
    schema = f"{RAW_SCHEMAS[FEEDS[feed]]}, date date"
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return (
        reader.json(f"{base}/raw/{feed}")
        .withColumns(
            {
                "_ingested_at": F.current_timestamp(),
                "_source": F.lit(source),
                "_file_path": F.col("_metadata.file_path"),
                "_media_type": F.lit(feed),
                "_extraction_date": F.col("date"),
            }
        )
        .drop("date")
    )


def add_batch(batch: DataFrame, stream: str, number: int, bronze: str) -> int:
    """Add a batch to the table unless it is there; returns the rows added."""
    named = batch.withColumn("_batch_id", F.lit(f"{stream}-{number}"))
    return append_bronze(named, bronze, (stream, number))


def ingest_available(spark: SparkSession, base: str, feed: str, source: str, bronze: str, checkpoint: str) -> None:
    """Append everything landed since the last run; the checkpoint makes a repeat a no-op."""

    def add(batch: DataFrame, number: int) -> None:
        # Numbers start anew with a new checkpoint, whose stream has another id.
        stream = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        add_batch(batch, stream, number, bronze)

    stream = landed_stream(spark, base, feed, source)
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    writer.foreachBatch(add).start().awaitTermination()
