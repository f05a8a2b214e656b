"""Whitening of embeddings by an incremental eigendecomposition.

Each partition folds its vectors one by one into a spectrum by centred rank-one updates; vectors that repeat in a batch
are one update with their number as weight. Spectra are merged a few at a time, by a rank-one update for each direction,
until one is left, which holds as many numbers as a covariance matrix. A last pass over all vectors projects them on its
directions and corrects these within the whole space they span (Rayleigh-Ritz), around the exact mean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_schema
from marquee.llm.spectrum import Spectrum
from marquee.llm.vectors import whole_vectors
from marquee.session import materialize

COMPONENTS, SCALE, OFFSET = 8, 1024, 100_000
# Components beyond this many units cannot be summed exactly.
UNITS = 1 << 40
# Spectra that one task merges.
MERGED = 8
# A component whose variance is below this share of the largest is none: its whitened values are 0.
FLAT = 1e-13

SPECTRUM = "part bigint, n double, mean array<double>, values array<double>, vectors array<double>"


def _matrix(batch: pa.RecordBatch | pa.Table, name: str = "x") -> np.ndarray:
    column = batch.column(name)
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _row(part: int, found: Spectrum, kind: pa.Schema) -> pa.RecordBatch:
    values = [part, found.n, found.mean.tolist(), found.values.tolist(), found.vectors.ravel().tolist()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, kind)], schema=kind)


def _spectra(known: DataFrame, size: int) -> DataFrame:
    """The spectrum of each partition with rows."""
    kind = arrow_schema(known.sparkSession, SPECTRUM)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Spectrum(size)
        for batch in batches:
            if batch.num_rows:
                rows, copies = np.unique(_matrix(batch), axis=0, return_counts=True)
                # In another order than the sorted one, which would drift along the first dimension.
                for at in np.random.default_rng(batch.num_rows).permutation(len(rows)):
                    found.add(rows[at].astype(np.float64), float(copies[at]))
        if found.n:
            yield _row(TaskContext.get().partitionId(), found, kind)

    return known.select("x").mapInArrow(run, SPECTRUM)


def _merged(spectra: DataFrame, size: int) -> Spectrum:
    """All spectra in one, by rounds of tasks that merge MERGED of them each."""
    kind = arrow_schema(spectra.sparkSession, SPECTRUM)

    def run(table: pa.Table) -> pa.Table:
        found = Spectrum(size)
        parts = table.column("part").to_pylist()
        mean, values, vectors = (_matrix(table, name) for name in ("mean", "values", "vectors"))
        for at in np.argsort(parts):
            other = Spectrum(size)
            other.n, other.mean = table.column("n")[int(at)].as_py(), mean[at]
            other.values, other.vectors = values[at], vectors[at].reshape(size, size)
            if found.n:
                found.merge(other)
            else:
                found = other
                found.values, found.vectors = other.values.copy(), other.vectors.copy()
        return pa.Table.from_batches([_row(parts[0] // MERGED, found, kind)], schema=kind)

    spectra = materialize(spectra, "spectra")
    left = spectra.agg(F.max("part")).first()[0] + 1
    while left > 1:
        left = -(-left // MERGED)
        spectra = spectra.groupBy(F.floor(F.col("part") / MERGED).alias("group")).applyInArrow(run, SPECTRUM)
    one = spectra.first()
    found = Spectrum(size)
    found.n, found.mean = one["n"], np.array(one["mean"])
    found.values, found.vectors = np.array(one["values"]), np.array(one["vectors"]).reshape(size, size)
    return found


def _summed(known: DataFrame, measure: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the flat array that `measure` makes of a batch of them; tasks send one sum each."""
    schema = "cell int, value double"
    kind = arrow_schema(known.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = measure(_matrix(batch))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], schema=kind)

    cells = known.select("x").mapInArrow(run, schema).groupBy("cell").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(cells)])


class Whitening:
    """Mean, directions (columns) and variances of whole vectors, the largest variance first.

    `n` and `sums` are exact, `trace` is the sum of all variances."""

    def __init__(self, n: int, sums: list[int], directions: np.ndarray, variances: np.ndarray) -> None:
        self.n, self.sums = n, sums
        self.directions, self.variances, self.trace = directions, variances, float(variances.sum())
        # n * x - sums must fit a long to be exact there; beyond, Python's whole numbers are.
        self.long = n * UNITS < 1 << 61

    def away(self, x: np.ndarray) -> np.ndarray:
        """n * (x - mean), in whole numbers."""
        kind = np.int64 if self.long else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean, each entry rounded once."""
        return (self.away(x) / self.n).astype(np.float64)

    def whitened(self, x: np.ndarray, most: int) -> np.ndarray:
        """Projections on the first directions, of variance one each; 0 on a direction without variance."""
        chosen = self.variances[:most]
        with np.errstate(all="ignore"):
            scale = np.where(chosen > FLAT * self.variances[0], 1 / np.sqrt(np.maximum(chosen, 0)), 0.0)
        return self.centred(x) @ self.directions[:, :most] * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of n * (x - mean), exact; none where it does not fit a long."""
        away = self.away(x)
        if self.long and float(np.abs(away).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (away * away).sum(axis=1).tolist()
        found = (sum(a * a for a in row) for row in away.tolist())
        return [s if s < 1 << 63 else None for s in found]


def fit(known: DataFrame) -> Whitening | None:
    """Mean, directions and variances of the column x, of longs; none for an empty table."""
    one = known.select(F.size("x").alias("size")).first()
    if one is None:
        return None
    size = one["size"]
    exact = [F.sum(F.col("x")[i].cast("decimal(18,0)")).alias(f"s{i}") for i in range(size)]
    totals = known.agg(F.count("*").alias("n"), *exact).first()
    n, sums = totals["n"], [int(totals[f"s{i}"]) for i in range(size)]
    rough = _merged(_spectra(known, size), size)
    basis, _ = np.linalg.qr(rough.vectors[:, ::-1])
    first = Whitening(n, sums, basis, rough.values[::-1] / n)

    def products(x: np.ndarray) -> np.ndarray:
        seen = first.centred(x) @ basis
        return (seen.T @ seen).ravel()

    ritz = _summed(known, products).reshape(size, size) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    return Whitening(n, sums, basis @ turn[:, ::-1], np.maximum(values[::-1], 0))


def identity_error(known: DataFrame, fitted: Whitening, components: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on all of them."""
    most = min(components, len(fitted.sums))

    def products(x: np.ndarray) -> np.ndarray:
        seen = fitted.whitened(x, most)
        return np.concatenate([seen.sum(axis=0), (seen.T @ seen).ravel()])

    sums = _summed(known, products) / fitted.n
    mean, second = sums[:most], sums[most:].reshape(most, most)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(most)).max())


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, *keep: Column) -> DataFrame:
    """Whitened values of every vector, a row for each vector and component.

    Components of vectors count as x = floor(scale * component) + offset. Columns: vec_id, component (from 1, by falling
    variance), n (vectors), deviation (sum of (n * x - sums)^2, exact; null where it does not fit a long), whitened (x
    less the mean, projected on the component, over the root of its variance), explained (its share of all variance),
    identity_error (`identity_error`, one value).

    Rows without a vector or with a null or non-finite component are left out, as are vectors of another length than
    most and components beyond UNITS (`vectors.whole_vectors`). A null or repeated vec_id is a row like any other. A
    component without variance has whitened values 0, and its share is 0; with no variance at all, as for one vector, all
    shares are 0. Vectors of fewer dimensions have fewer components. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    whole = whole_vectors(rows, scale, UNITS, rows["vec_id"].cast("bigint").alias("vec_id"))
    known = materialize(whole.select("vec_id", F.transform("x", lambda x: x + offset).alias("x")), "whole-vectors")
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    fitted = fit(known)
    if fitted is None:
        return spark.createDataFrame([], schema)
    most = min(components, len(fitted.sums))
    error = identity_error(known, fitted, components)
    shares = (fitted.variances[:most] / fitted.trace if fitted.trace else np.zeros(most)).tolist()
    kind = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, rows = _matrix(batch), batch.num_rows
            each = pa.array(np.repeat(np.arange(rows), most))
            columns = {
                "vec_id": batch.column("vec_id").take(each),
                "component": np.tile(np.arange(1, most + 1), rows),
                "n": np.full(rows * most, fitted.n),
                "deviation": pa.array(fitted.deviations(x), pa.int64()).take(each),
                "whitened": fitted.whitened(x, most).ravel(),
                "explained": np.tile(shares, rows),
                "identity_error": np.full(rows * most, error),
            }
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in kind], schema=kind)

    return known.mapInArrow(run, schema)
