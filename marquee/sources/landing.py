"""Landed JSON: one folder per feed and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.contracts import FEEDS, RAW_SCHEMAS, RESPONSE_SCHEMA
from marquee.functions.lenient import text_or_empty

CORRUPT = "_corrupt_record"


def landing_path(base: str, feed: str, day: dt.date | str) -> str:
    return f"{base}/raw/{feed}/date={day}"


def read_raw(spark: SparkSession, base: str, feed: str, day: dt.date | str, json_array: bool = False) -> DataFrame:
    """Records of a feed and day under a fixed schema; a record that is no JSON lands in `_corrupt_record`.

    JSON lines split over tasks. `json_array` reads files that hold one array
    each, which cannot be split; land large feeds as lines.
    """
    reader = spark.read.schema(RAW_SCHEMAS[FEEDS[feed]]).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", json_array)
    return reader.json(landing_path(base, feed, day))


def field_census(spark: SparkSession, base: str, feed: str, day: dt.date | str, json_array: bool = False) -> DataFrame:
    """How many records of a feed and day name each field, whatever a schema expects: field, records.

    The names come from the landed text itself, in one pass; what is no JSON object names nothing.
    """
    text = spark.read.text(landing_path(base, feed, day), wholetext=json_array)
    if json_array:
        keys = F.transform(F.from_json("value", "array<map<string,string>>"), lambda record: F.map_keys(record))
        names = text.select(F.explode(keys).alias("keys"))
    else:
        names = text.select(F.json_object_keys("value").alias("keys"))
    return names.select(F.explode("keys").alias("field")).groupBy("field").agg(F.count("*").alias("records"))


def with_lineage(
    df: DataFrame, feed: str, day: dt.date | str, batch_id: str, source: str, file_path: Column | None = None
) -> DataFrame:
    """Where each record came from and when."""
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source": F.lit(source),
            "_batch_id": F.lit(batch_id),
            "_file_path": F.col("_metadata.file_path") if file_path is None else file_path,
            "_media_type": F.lit(feed),
            "_extraction_date": F.lit(str(day)).cast("date"),
        }
    )


def write_landing(df: DataFrame, base: str, feed: str, day_column: str = "date") -> None:
    """JSON lines under date=YYYY-MM-DD; a re-run replaces the days it holds.

    Rebalancing splits a day that holds most rows over several files.
    """
    writer = df.hint("rebalance", day_column).write.mode("overwrite").partitionBy(day_column)
    writer.option("partitionOverwriteMode", "dynamic").json(f"{base}/raw/{feed}")


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def parse_lines(df: DataFrame, column: str, schema: str) -> DataFrame:
    """JSON text of a column as fields; malformed text is kept in `_corrupt_record`."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(column, f"{schema}, {CORRUPT} string", options)
    return df.withColumn("_parsed", parsed).select(*df.columns, "_parsed.*")


def positioned_results(df: DataFrame, column: str, media: str, source: str, extracted_at: Column) -> DataFrame:
    """Entries of a response's `results` list with their 1-based place in it."""
    parsed = df.withColumn("_results", F.from_json(column, RESPONSE_SCHEMA)["results"])
    kept = [c for c in df.columns if c != column]
    entries = parsed.select(*kept, F.posexplode("_results").alias("_index", "_entry"))
    return entries.select(
        *kept,
        "_entry.*",
        (F.col("_index") + 1).alias("_position"),
        F.lit(media).alias("_media_type"),
        F.lit(source).alias("_source"),
        extracted_at.alias("_extracted_at"),
    )


def billed_cast(df: DataFrame, credits: Column, n: int) -> DataFrame:
    """First n cast entries of nested credits, one row each; names and roles default to empty, order to 0."""
    return df.select("movie_id", F.inline(F.slice(credits["cast"], 1, n))).select(
        "movie_id",
        F.col("id").alias("person_id"),
        text_or_empty("name").alias("name"),
        text_or_empty("character").alias("character_name"),
        F.coalesce("order", F.lit(0)).alias("cast_order"),
        text_or_empty("known_for_department").alias("known_for_department"),
        F.coalesce("popularity", F.lit(0.0)).alias("popularity"),
    )
