"""Defaults, required columns and references of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.contracts import DEFAULTS, FOREIGN_KEYS, NOT_NULL, STAR_SCHEMA


def with_defaults(batch: DataFrame, table: str) -> DataFrame:
    """The table's columns and types; a column that is absent or null takes its default, if it has one."""
    filled = []
    for field in StructType.fromDDL(STAR_SCHEMA[table]).fields:
        known = F.col(field.name) if field.name in batch.columns else F.lit(None)
        default = DEFAULTS.get(table, {}).get(field.name)
        value = known.cast(field.dataType)
        filled.append((value if default is None else F.coalesce(value, F.lit(default).cast(field.dataType))).alias(field.name))
    return batch.select(*filled)


def dependents(table: str) -> list[tuple[str, str, str, str]]:
    """References to a table: (table that refers, its column, column referred to, what a delete does to it).

    Those a delete carries along come before those it empties, so that no row is emptied only to be removed."""
    found = [(child, column, parent_column, action) for child, column, parent, parent_column, action in FOREIGN_KEYS if parent == table]
    return sorted(found, key=lambda f: f[3] != "cascade")


def _is_null(names: list[str]) -> Column:
    return F.concat_ws(", ", *[F.when(F.col(n).isNull(), F.lit(f"no {n}")) for n in names])


def violations(batch: DataFrame, table: str, parents: dict[str, DataFrame]) -> DataFrame:
    """Rows of a batch with `violation`: what keeps a row out of the table, null if nothing does.

    References are looked up once for each distinct key, so a title with most of the rows joins as one; a null
    reference refers to nothing and is only wrong where the column is required. Parents that are not given are
    not looked up.
    """
    checked = batch
    found = [F.nullif(_is_null(NOT_NULL.get(table, [])), F.lit(""))]
    for child, column, parent, parent_column, _ in FOREIGN_KEYS:
        if child == table and parent in parents:
            known = parents[parent].select(F.col(parent_column).alias(column))
            unknown = batch.select(column).filter(F.col(column).isNotNull()).distinct().join(known, column, "left_anti")
            checked = checked.join(unknown.withColumn(f"_no_{column}", F.lit(True)), column, "left")
            found.append(F.when(F.col(f"_no_{column}"), F.lit(f"unknown {column}")))
    reason = F.nullif(F.concat_ws(", ", *found), F.lit(""))
    return checked.select(*[F.col(c) for c in batch.columns], reason.alias("violation"))


def screened(batch: DataFrame, table: str, parents: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Rows that may enter the table, defaults filled in, and the rows that may not, with the reason."""
    judged = violations(with_defaults(batch, table), table, parents)
    good = judged.filter(F.col("violation").isNull()).drop("violation")
    return good, judged.filter(F.col("violation").isNotNull())
