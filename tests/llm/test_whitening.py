"""Whitening against a plain eigendecomposition, and the rank-one updates under it."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import whitening
from marquee.llm.spectrum import Spectrum, secular_roots

SCHEMA = "vec_id bigint, embedding array<float>"


def table(seed, n, size=10, copies=0):
    draw = random.Random(seed)
    spread = [1 + 2.0 * (size - k) for k in range(size)]
    rows = [(i, [draw.gauss(0.3, 0.05) * s for s in spread]) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(copies)]


def check(found, rows, most=8):
    """All columns against whole-number arithmetic and a plain eigendecomposition of the covariance."""
    x = {i: [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for i, v in rows}
    n, size = len(x), len(next(iter(x.values())))
    sums = [sum(v[k] for v in x.values()) for k in range(size)]
    away = {i: [n * a - s for a, s in zip(v, sums)] for i, v in x.items()}
    centred = np.array([[a / n for a in v] for v in away.values()])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = dict(zip(away, centred @ vectors[:, :most] / np.sqrt(values[:most])))
    assert sorted((r["vec_id"], r["component"]) for r in found) == sorted((i, c + 1) for i in x for c in range(min(most, size)))
    sign = {}
    for r in found:
        expected = want[r["vec_id"]][r["component"] - 1]
        if abs(expected) > 0.1:
            sign.setdefault(r["component"], np.sign(expected * r["whitened"]))
    for r in found:
        c = r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum(a * a for a in away[r["vec_id"]])
        assert abs(r["whitened"] * sign[c + 1] - want[r["vec_id"]][c]) < 1e-8
        assert abs(r["explained"] - values[c] / values.sum()) < 1e-9
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in found}) == 1


@pytest.mark.parametrize("parts,copies", [(1, 0), (7, 0), (20, 300)])
def test_against_plain_eigenvectors(spark, parts, copies):
    rows = table(parts, 400, copies=copies)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    check(whitening.whiten(df).collect(), rows)


def test_rows_left_out(spark):
    rows = table(3, 90)
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, [nan] * 10), (902, [inf] + [0.0] * 9), (903, [None] + [0.0] * 9), (904, [0.0] * 4), (905, []), (906, [1e30] * 10)]
    check(whitening.whiten(spark.createDataFrame(rows + odd, SCHEMA).repartition(3)).collect(), rows)


def test_few_dimensions_clashing_columns_and_null_ids(spark):
    rows = table(4, 50, size=3)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("x", "n", "part", "component", "values", "cell"):
        df = df.withColumn(name, F.lit("clash"))
    check(whitening.whiten(df).collect(), rows)
    nameless = spark.createDataFrame(rows + [(None, rows[1][1]), rows[2]], SCHEMA)
    assert whitening.whiten(nameless).count() == 3 * 52


def test_empty_single_and_equal_vectors(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    for rows in ([(1, [0.5, 0.25])], [(1, [0.5, 0.25])] * 5):
        found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
        assert len(found) == 2 * len(rows)
        assert all((r["whitened"], r["explained"], r["deviation"]) == (0.0, 0.0, 0) for r in found)
    flat = [(i, [i / 8.0, 1.0, 1.0]) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r["component"]: r["explained"] for r in found}[1] == pytest.approx(1)
    assert all(r["whitened"] == 0 for r in found if r["component"] > 1)


def test_deviations_beyond_a_long():
    fitted = whitening.Whitening(3, [0, 0], np.eye(2), np.ones(2))
    fitted.long = False
    assert fitted.deviations(np.array([[1 << 29, 1], [1 << 33, 0]])) == [(3 << 29) ** 2 + 9, None]


@pytest.mark.parametrize("kind", ["random", "repeated", "few", "whole", "flat"])
def test_rank_one_updates(kind):
    draw = np.random.default_rng(7)
    rows = draw.normal(size=(200, 12)) * np.arange(1, 13) + 1e5
    rows = {"random": rows, "repeated": np.vstack([rows[:20], np.tile(rows[0], (50, 1)), rows[:20]]), "few": rows[:5], "whole": np.rint(rows), "flat": rows * (np.arange(12) < 3)}[kind]
    one, first, second = Spectrum(12), Spectrum(12), Spectrum(12)
    for k, row in enumerate(rows):
        one.add(row)
        (first if k % 3 else second).add(row)
    first.merge(second)
    away = rows - rows.mean(axis=0)
    scatter = away.T @ away
    for found in (one, first):
        assert found.n == len(rows) and np.abs(found.mean - rows.mean(axis=0)).max() < 1e-9
        assert np.abs(found.vectors.T @ found.vectors - np.eye(12)).max() < 1e-12
        again = found.vectors * found.values @ found.vectors.T
        assert np.abs(again - scatter).max() < 1e-11 * np.abs(scatter).max()
        assert (np.diff(found.values) >= 0).all()


def test_copies_are_a_weight():
    draw = np.random.default_rng(8)
    rows = draw.normal(size=(30, 5))
    each, weighted = Spectrum(5), Spectrum(5)
    for k, row in enumerate(rows):
        weighted.add(row, k % 4 + 1)
        for _ in range(k % 4 + 1):
            each.add(row)
    assert np.abs(each.values - weighted.values).max() < 1e-11 and each.n == weighted.n


@pytest.mark.parametrize("k", [1, 2, 3, 40])
def test_secular_roots(k):
    draw = np.random.default_rng(k)
    poles, weights = np.sort(draw.random(k)), draw.random(k) ** 8 + 1e-14
    roots, distances = secular_roots(poles, weights)
    want = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
    assert np.abs(roots - want).max() < 1e-13 * max(1, want.max())
    assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()
    assert np.abs(distances - (roots[:, None] - poles[None, :])).max() < 1e-13
