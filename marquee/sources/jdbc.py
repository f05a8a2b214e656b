"""Staging, upsert and read-back over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.contracts import JDBC_BATCH_ROWS


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    # Open connections of one write: tasks beyond it are coalesced.
    connections: int = 32
    extra: dict[str, str] = field(default_factory=dict)

    @property
    def properties(self) -> dict[str, str]:
        return {
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "batchsize": str(JDBC_BATCH_ROWS),
            "isolationLevel": "READ_COMMITTED",
            "numPartitions": str(self.connections),
            **self.extra,
        }


def write_staging(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Replace the staging table; only the writers are as few as the connections, not the scan before them."""
    df.repartition(target.connections).write.jdbc(target.url, table, mode="overwrite", properties=target.properties)


def append(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Add rows known not to be there yet."""
    df.repartition(target.connections).write.jdbc(target.url, table, mode="append", properties=target.properties)


def read_table(
    spark: SparkSession, target: JdbcTarget, table: str, column: str | None = None, bounds: tuple | None = None
) -> DataFrame:
    """A table, read in parallel ranges of `column` when bounds are given."""
    if column is None or bounds is None:
        return spark.read.jdbc(target.url, table, properties=target.properties)
    low, high = bounds
    return spark.read.jdbc(
        target.url, table, column=column, lowerBound=low, upperBound=high,
        numPartitions=target.connections, properties=target.properties,
    )


def row_count(spark: SparkSession, target: JdbcTarget, table: str) -> int:
    """Counted by the database: one row crosses the wire."""
    return read_table(spark, target, f"(SELECT COUNT(*) AS n FROM {table}) counted").select(F.col("n")).first()["n"]


def upsert_statement(staging: str, table: str, key: list[str], columns: list[str]) -> str:
    """Insert staged rows, updating all other columns where the key exists."""
    updated = [c for c in columns if c not in key]
    names = ", ".join(columns)
    action = "UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in updated) if updated else "NOTHING"
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({', '.join(key)}) DO {action}"
    )


def drop_statement(staging: str) -> str:
    return f"DROP TABLE IF EXISTS {staging}"


def execute(spark: SparkSession, target: JdbcTarget, statement: str) -> int:
    """Run one statement in the database; no rows pass through the driver."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(target.url, target.user, target.password)
    try:
        prepared = connection.createStatement()
        try:
            return prepared.executeUpdate(statement)
        finally:
            prepared.close()
    finally:
        connection.close()
