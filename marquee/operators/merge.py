"""Keyed merges as joins of unique keys.

Each side has at most one row per key, so no key is hot in the join. The caller
checks staging keys with `quality.require_unique` before it merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.keys import deduplicate


def upsert(
    target: DataFrame,
    staging: DataFrame,
    key: list[str],
    keep: list[str] | None = None,
    stamp: dict[str, Column] | None = None,
) -> DataFrame:
    """Target with staged rows inserted, or their columns updated where the key exists.

    `keep` names columns an update leaves as they are; `stamp` sets columns of
    every staged row, such as the time of the merge.
    """
    stamp = stamp or {}
    staged = staging.withColumns(stamp) if stamp else staging
    names = [c for c in target.columns if c not in key]
    if not keep:
        # Nothing of an updated row survives: drop it, and no column needs pairing up.
        untouched = target.join(staged.select(*key), key, "left_anti")
        return untouched.unionByName(staged.select(*target.columns))
    old = target.withColumn("_old", F.lit(True))
    new = staged.select(*key, *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_new"))
    merged = old.join(new, key, "full_outer")

    def chosen(name: str) -> Column:
        if name in keep:
            return F.when(F.col("_old"), F.col(name)).otherwise(F.col(f"_new_{name}"))
        return F.when(F.col("_new"), F.col(f"_new_{name}")).otherwise(F.col(name))

    return merged.select(*[F.col(c) if c in key else chosen(c).alias(c) for c in target.columns])


def replace_by_key(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Delete target rows whose key occurs in the batch, then add the batch."""
    kept = target.join(batch.select(*key), key, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def absent(target: DataFrame, batch: DataFrame, key: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """Batch rows whose key the target lacks; of a repeated key the first row in order."""
    first = deduplicate(batch.select(*target.columns), key, order_by or [], keep="first")
    return first.join(target.select(*key), key, "left_anti").select(*target.columns)


def insert_absent(target: DataFrame, batch: DataFrame, key: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """Target with the batch rows whose key is new; existing rows stay."""
    return target.unionByName(absent(target, batch, key, order_by))


def delete_cascade(dependent: DataFrame, column: str, deleted: DataFrame, parent_column: str) -> DataFrame:
    """Dependent rows without those that refer to a deleted parent."""
    return dependent.join(deleted.select(F.col(parent_column).alias(column)), column, "left_anti")


def set_null(dependent: DataFrame, column: str, deleted: DataFrame, parent_column: str) -> DataFrame:
    """References to deleted parents become null, the rows stay."""
    gone = deleted.select(F.col(parent_column).alias(column), F.lit(True).alias("_gone")).dropDuplicates([column])
    marked = dependent.join(gone, column, "left")
    kept = F.when(F.col("_gone"), F.lit(None)).otherwise(F.col(column))
    return marked.withColumn(column, kept).select(*dependent.columns)
