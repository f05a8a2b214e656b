"""Keep one row, or the first n, of every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deduplicate(df: DataFrame, keys: list[str], order_by: list[Column], keep: str = "last") -> DataFrame:
    """One row per key: the last or the first in the given ascending order.

    The filter on row_number lets Catalyst cut every map partition to one row per
    key before the shuffle (WindowGroupLimit), so a key with a third of all rows
    reaches its reducer as one row per map task. Rows the order leaves tied are
    told apart by a hash of all their columns, so a re-run keeps the same one.
    """
    tie = F.xxhash64(*df.columns)
    order = [*order_by, tie] if keep == "first" else [o.desc_nulls_last() for o in [*order_by, tie]]
    return top_rows(df, keys, order, 1)


def top_rows(df: DataFrame, by: list[str], order_by: list[Column], n: int) -> DataFrame:
    """First n rows of each group, pruned per map partition in the same way."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))
    return df.withColumn("_place_in_group", place).filter(F.col("_place_in_group") <= n).drop("_place_in_group")
