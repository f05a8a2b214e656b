"""Tables whose versions are published one at a time, whoever writes.

A table is a folder of Parquet parts: a part is a day, or a bucket of keys. A write adds a folder of its own and then
publishes a manifest, which names for every part the folders that hold it and their rows. A manifest's number can be
taken only once, so of two writers the later one has to look again: if the other changed none of its parts, its own
parts join the newer version; else it computes them anew. Readers see whole versions, a failed write leaves the last
one, and parts that a write does not touch are neither read nor written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# Attempts at publishing before a write gives up, and folders a part may consist of before an append rewrites it.
ATTEMPTS, SEGMENTS = 20, 8
BUCKET = StructField("bucket", IntegerType())
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# The one part of a table without columns to part it by.
WHOLE = "all"


def write_counted(df: DataFrame, path: str, mode: str, partitions: list[str], overwrite: str = "dynamic") -> int:
    """Write Parquet files and return their row count.

    Rebalanced on the partition columns first: few files for each partition, and adaptive execution splits one that
    holds most of the rows."""
    seen = Observation()
    if partitions:
        df = df.hint("rebalance", *partitions)
    # Observed after the shuffle, in the stage that writes: a map task run again after
    # a lost executor is not counted twice.
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).option("partitionOverwriteMode", overwrite)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return seen.get["rows"]


class Conflict(RuntimeError):
    """Other writers kept changing the same parts."""


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content unless it exists; False if another writer was first.

    The content is written under another name and then linked or renamed, neither of which replaces a file: a link on
    a local disk, where a rename would, and a rename on a distributed file system.
    """
    jvm = spark._jvm
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    real = system.resolvePath(draft)
    if real.toUri().getScheme() != "file":
        done = not system.exists(target) and system.rename(draft, target)
        if not done:
            system.delete(draft, False)
        return done
    own = jvm.java.io.File(real.toUri().getPath())
    try:
        jvm.java.nio.file.Files.createLink(jvm.java.io.File(own.getParent(), target.getName()).toPath(), own.toPath())
        return True
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" in problem.java_exception.getClass().getName():
            return False
        raise
    finally:
        own.delete()


@dataclass
class Manifest:
    """What a version consists of: for each part its folders and their rows; the columns of the parts; the schema of
    its rows; the last batch of each stream."""

    version: int = 0
    parts: dict[str, list[list]] = field(default_factory=dict)
    by: list[str] = field(default_factory=list)
    schema: str = ""
    batches: dict[str, int] = field(default_factory=dict)

    def rows(self, parts: list[str] | None = None) -> int:
        chosen = self.parts if parts is None else parts
        return sum(n for part in chosen for _, n in self.parts.get(part, []))


def joined(known: StructType, fresh: StructType) -> StructType:
    """Columns of both, by name; a column may not change its type."""
    types = {f.name: f.dataType for f in known.fields}
    for f in fresh.fields:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return StructType([*known.fields, *(f for f in fresh.fields if f.name not in types)])


def nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema.fields])


class Table:
    """One table: `by` names the columns of its parts, or `keys` those whose hash deals rows to `buckets`.

    Without a given schema the table has that of the rows it gets; columns may be added, not changed.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: str | None = None, by: str | list[str] | None = None,
        keys: list[str] | None = None, buckets: int = 32,
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = StructType.fromDDL(schema) if schema else None
        self.by, self.keys, self.buckets = [by] if isinstance(by, str) else by or [], keys or [], buckets
        self.columns = [BUCKET.name] if self.keys else self.by

    # --- manifests ---

    def _path(self, version: int) -> str:
        return f"{self.root}/_log/{version:012d}.json"

    def newest(self) -> Manifest:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_log")
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return Manifest()
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        published = sorted(n for n in names if n.endswith(".json"))
        if not published:
            return Manifest()
        stream = system.open(self.spark._jvm.org.apache.hadoop.fs.Path(folder, published[-1]))
        try:
            return Manifest(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _publish(self, base: Manifest, replaced: list[str], added: dict[str, list]) -> bool:
        """Publish parts made from `base`; False if another writer has changed one of them since."""
        touched = {*replaced, *added}
        for _ in range(ATTEMPTS):
            newest = self.newest()
            if any(newest.parts.get(p) != base.parts.get(p) for p in touched):
                return False
            if self._put(newest, replaced, added, newest.schema, newest.batches):
                return True
        return False

    def _put(self, newest: Manifest, replaced: Iterable[str], added: dict[str, list], schema: str, batches: dict) -> bool:
        gone = set(replaced)
        parts = {p: s for p, s in newest.parts.items() if p not in gone}
        for part, segment in added.items():
            parts[part] = [*parts.get(part, []), segment]
        found = {"version": newest.version + 1, "parts": parts, "by": self.columns, "schema": schema, "batches": batches}
        return put_if_absent(self.spark, self._path(newest.version + 1), json.dumps(found))

    # --- rows ---

    def part(self) -> Column:
        """The part of a row, as text."""
        if self.keys:
            return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")
        if not self.by:
            return F.lit(WHOLE)
        return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)) for c in self.by])

    def parts_of(self, rows: DataFrame) -> list[str]:
        """Parts that rows fall in: a day each, or one of a fixed number of buckets."""
        return sorted(r[0] for r in rows.select(self.part().alias("part")).distinct().collect())

    def _folder(self, commit: str, part: str) -> str:
        values = part.split("/") if self.columns else []
        return "/".join([self.root, f"commit={commit}", *(f"{c}={v}" for c, v in zip(self.columns, values))])

    def _schema(self, version: Manifest) -> StructType:
        return self.schema or (StructType.fromJson(json.loads(version.schema)) if version.schema else StructType())

    def read(self, parts: list[str] | None = None, version: Manifest | None = None) -> DataFrame:
        """The newest version, or the given parts of a version; filters on the columns of the parts skip the others."""
        version = version or self.newest()
        schema = self._schema(version)
        chosen = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
        paths = [self._folder(c, p) for p, segments in chosen.items() for c, n in segments if n]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = StructType([*schema.fields, BUCKET]) if self.keys else schema
        found = self.spark.read.schema(stored).option("basePath", self.root).parquet(*paths)
        return found.select(*schema.fieldNames())

    def _write(self, rows: DataFrame) -> tuple[str, dict[str, int]]:
        """Write rows to a folder of their own; its name, and the rows of each part."""
        commit = uuid.uuid4().hex
        path = f"{self.root}/commit={commit}"
        named = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")) if self.keys else rows
        if not self.columns:
            return commit, {WHOLE: write_counted(named, path, "errorifexists", [])}
        # A day with most of the rows is split over several files.
        named.hint("rebalance", *self.columns).write.partitionBy(*self.columns).parquet(path)
        schema = StructType([BUCKET] if self.keys else [named.schema[c] for c in self.by])
        counts = self.spark.read.schema(schema).parquet(path).groupBy(*self.columns).count().collect()
        return commit, {"/".join(NO_VALUE if v is None else str(v) for v in r[:-1]): r[-1] for r in counts}

    def replace(self, rows: DataFrame, whole: bool = False) -> int:
        """Replace the parts that the rows fall in, or the whole table; returns the rows written."""
        return self._put_rows(rows, lambda newest, counts: newest.parts if whole else counts, None, whole)

    def add(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Add rows. `batch` names a stream and the number of its batch: one at or below the last adds nothing."""
        if batch and self.newest().batches.get(batch[0], -1) >= batch[1]:
            return 0
        return self._put_rows(rows, lambda newest, counts: (), batch, False)

    def _put_rows(self, rows: DataFrame, replaced: Callable, batch: tuple[str, int] | None, whole: bool) -> int:
        commit, counts = self._write(rows)
        added, fresh = {p: [commit, n] for p, n in counts.items()}, nullable(rows.schema)
        for _ in range(ATTEMPTS):
            newest = self.newest()
            if batch and newest.batches.get(batch[0], -1) >= batch[1]:
                return 0
            schema = fresh if whole else joined(self._schema(newest), fresh)
            batches = {**newest.batches, batch[0]: batch[1]} if batch else newest.batches
            if self._put(newest, replaced(newest, counts), added, schema.json(), batches):
                return sum(counts.values())
        raise Conflict(f"{self.root}: {ATTEMPTS} attempts")

    def rewrite(self, parts: list[str], build: Callable[[DataFrame], DataFrame]) -> tuple[int, int]:
        """Replace parts by what `build` makes of their rows; returns the rows they had and have.

        `build` runs again if another writer changes one of the parts meanwhile.
        """
        for _ in range(ATTEMPTS):
            base = self.newest()
            commit, counts = self._write(build(self.read(parts, base)).select(*self._schema(base).fieldNames()))
            if stray := sorted({*counts} - {*parts}):
                raise ValueError(f"{self.root}: a merge of {len(parts)} parts made rows of others: {stray[:5]}")
            if self._publish(base, parts, {p: [commit, n] for p, n in counts.items()}):
                return base.rows(parts), sum(counts.values())
        raise Conflict(f"{self.root}: {ATTEMPTS} attempts at {len(parts)} parts")

    def append(self, parts: list[str], build: Callable[[DataFrame], DataFrame]) -> int:
        """Add what `build` makes of the rows of these parts to them; returns the rows added.

        Files of earlier writes stay; a part that consists of SEGMENTS folders is rewritten as one with what it gets.
        """
        for _ in range(ATTEMPTS):
            base = self.newest()
            fresh = build(self.read(parts, base)).select(*self._schema(base).fieldNames())
            worn = [p for p in parts if len(base.parts.get(p, [])) >= SEGMENTS]
            if worn:
                fresh = fresh.unionByName(self.read(worn, base))
            commit, counts = self._write(fresh)
            if not counts or self._publish(base, worn, {p: [commit, n] for p, n in counts.items()}):
                return sum(counts.values()) - base.rows(worn)
        raise Conflict(f"{self.root}: {ATTEMPTS} attempts at {len(parts)} parts")
