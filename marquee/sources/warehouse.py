"""Star-schema tables on shared storage.

Facts and aggregates have a part for each day, week or month, dimensions and bridges for each bucket of keys. A merge
reads and writes only the parts that its batch falls in, links are appended without touching those there are, and a
delete carries the references to what it removes along. Every write is published as one version (`commits`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.contracts import FOREIGN_KEYS, LISTING_ORDER, PAGE_ROWS, STAR_KEYS, STAR_SCHEMA
from marquee.operators import merge as merges
from marquee.operators.integrity import dependents, screened
from marquee.operators.quality import QualityError, require_unique
from marquee.operators.serving import listing
from marquee.session import materialize
from marquee.sources.commits import Table

PARTITIONED = {"fact_daily_trends": "date", "agg_weekly_summary": "week_start", "agg_monthly_genres": "month"}
# Columns that deal a table to buckets: links of a title stand together, so that a title is removed from one bucket.
BUCKETED = {
    "dim_genres": ["genre_id"],
    "dim_movies": ["movie_id"],
    "dim_people": ["person_id"],
    "bridge_movie_genres": ["movie_id"],
    "bridge_movie_cast": ["movie_id"],
}
# Buckets of a table, for its whole life. A bucket should be a few hundred megabytes.
BUCKETS = {"dim_genres": 1}
DEFAULT_BUCKETS = 32

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: dict[str, int] | None = None) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), {**BUCKETS, **(buckets or {})}

    def table(self, name: str) -> Table:
        buckets = self.buckets.get(name, DEFAULT_BUCKETS)
        return Table(self.spark, f"{self.root}/{name}", STAR_SCHEMA[name], PARTITIONED.get(name), BUCKETED.get(name), buckets)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def page(self, name: str, number: int, rows: int = PAGE_ROWS) -> DataFrame:
        """A page of a table in the order it is listed in, numbered from 1.

        The manifest tells how many rows each day, week or month has, so only those that the page falls in are read and
        sorted; earlier pages are neither read nor carried along.
        """
        table, skip, chosen = self.table(name), (number - 1) * rows, []
        first, way = LISTING_ORDER[name][0]
        if table.by != [first]:
            return listing(table.read(), name).offset(skip).limit(rows)
        newest, wanted = table.newest(), rows
        for part in sorted(newest.parts, reverse=way == "desc"):
            held = newest.rows([part])
            if not chosen and skip >= held:
                skip -= held
            elif wanted > 0:
                wanted -= held - (0 if chosen else skip)
                chosen.append(part)
        return listing(table.read(chosen, newest), name).offset(skip if chosen else 0).limit(rows)

    def _screened(self, name: str, batch: DataFrame) -> DataFrame:
        """The batch with defaults filled in. One row without a required value or with a reference to nothing makes
        the whole batch fail, as it does in a database."""
        parents = {parent: self.read(parent) for table, _, parent, _, _ in FOREIGN_KEYS if table == name}
        good, bad = screened(batch, name, parents)
        first = bad.first()
        if first is not None:
            raise QualityError(f"{name}: {first['violation']}, e.g. {first.asDict()}")
        return good

    def _staged(self, name: str, batch: DataFrame, unique: bool) -> DataFrame:
        """The batch in the table's columns and types, written once: keys, parts and the merge all read it."""
        schema = StructType.fromDDL(STAR_SCHEMA[name])
        typed = batch.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in batch.columns])
        absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in batch.columns}
        staged = materialize(typed.withColumns(absent) if absent else typed, f"staged-{name}")
        if unique:
            require_unique(staged, STAR_KEYS[name], name)
        return staged

    def merge_checked(self, name: str, batch: DataFrame, how: Merge, unique: bool = True) -> int:
        """Merge a batch under the schema's rules: required values, references and defaults."""
        return self.merge(name, self._screened(name, batch), how, unique)

    def merge(self, name: str, batch: DataFrame, how: Merge, unique: bool = True) -> int:
        """Merge a batch into the parts of a table that it falls in, and return the rows written."""
        staged, table = self._staged(name, batch, unique), self.table(name)
        parts = table.parts_of(staged)
        return table.rewrite(parts, lambda old: how(old, staged))[1] if parts else 0

    def append_checked(self, name: str, batch: DataFrame, order_by: list[Column] | None = None) -> int:
        """Add the rows of a batch whose key is new, under the schema's rules, and return their number.

        Of a repeated key the first row in order is added. Only the new rows are written."""
        staged, table, key = self._staged(name, self._screened(name, batch), unique=False), self.table(name), STAR_KEYS[name]
        parts = table.parts_of(staged)
        return table.append(parts, lambda old: merges.absent(old, staged, key, order_by)) if parts else 0

    def delete(self, name: str, keys: DataFrame) -> dict[str, int]:
        """Delete rows by key, and what refers to them by the rule of each reference; rows changed by table and rule.

        References go first and rows last, so that no reader finds a reference to nothing, and a delete that failed
        half way is completed by another one.
        """
        gone = materialize(keys.select(*STAR_KEYS[name]).distinct(), f"deleted-{name}")
        changed: dict[str, int] = {}
        self._delete(name, gone, changed)
        return changed

    def _delete(self, name: str, gone: DataFrame, changed: dict[str, int]) -> None:
        for child, column, parent_column, action in dependents(name):
            table, refers = self.table(child), gone.select(F.col(parent_column).alias(column)).distinct()
            hit = table.read().join(refers, column, "left_semi")
            if action == "cascade" and dependents(child):
                self._delete(child, materialize(hit.select(*STAR_KEYS[child]), f"deleted-{child}"), changed)
                continue
            parts = table.parts_of(hit)
            if not parts:
                continue
            if action == "cascade":
                had, have = table.rewrite(parts, lambda old: merges.delete_cascade(old, column, gone, parent_column))
                changed[f"{child} cascade"] = changed.get(f"{child} cascade", 0) + had - have
            else:
                hits = hit.count()
                table.rewrite(parts, lambda old: merges.set_null(old, column, gone, parent_column))
                changed[f"{child} {action}"] = changed.get(f"{child} {action}", 0) + hits
        table, key = self.table(name), STAR_KEYS[name]
        parts = table.parts_of(table.read().join(gone, key, "left_semi"))
        if parts:
            had, have = table.rewrite(parts, lambda old: old.join(gone, key, "left_anti"))
            changed[name] = changed.get(name, 0) + had - have
