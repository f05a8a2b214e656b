"""Bronze, silver and gold tables, published version by version (`commits`).

A scan plans from the manifest: it names the folders, the rows and the schema, so no footer is opened for a schema that
may have gained a column. A mart is switched when it is wholly written; a write that fails leaves the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.contracts import GOLD_PARTITIONS, SILVER_DROPS
from marquee.sources.commits import Table

MONTHS, DAYS = ["year", "month"], ["extraction_date"]


class NoTable(FileNotFoundError):
    """Nothing has been published there."""


def layer(spark: SparkSession, path: str, by: list[str]) -> Table:
    return Table(spark, path, by=by)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a layer's table."""
    newest = Table(spark, path).newest()
    if not newest.version:
        raise NoTable(path)
    return Table(spark, path, by=newest.by).read(version=newest)


def with_month_partitions(df: DataFrame, day: str = "_extraction_date") -> DataFrame:
    return df.withColumns({"year": F.year(day), "month": F.month(day)})


def append_bronze(df: DataFrame, path: str, batch: tuple[str, int] | None = None) -> int:
    """Add records to their months. `batch` names a stream and its batch, which is added once however often it is sent."""
    return layer(df.sparkSession, path, MONTHS).add(with_month_partitions(df), batch)


def overwrite_silver_days(df: DataFrame, path: str) -> int:
    """Replace the extraction dates the batch holds; other dates stay."""
    return layer(df.sparkSession, path, DAYS).replace(df.drop(*SILVER_DROPS))


def overwrite_gold(df: DataFrame, path: str, name: str, whole: bool = True) -> int:
    """Replace a mart as a whole, or the partitions that the rows fall in."""
    return layer(df.sparkSession, path, GOLD_PARTITIONS[name]).replace(df, whole)


def run_summary(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """One row per table of a run: name, counts, status, error."""
    schema = "table string, rows_read bigint, rows_written bigint, status string, error string"
    fields = ["table", "rows_read", "rows_written", "status", "error"]
    return spark.createDataFrame([tuple(row.get(f) for f in fields) for row in rows], schema)
