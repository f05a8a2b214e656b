"""Hard negatives against a plain search in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, every=5, n_positives=5, n_negatives=3):
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        usable.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in vector], label))
    sizes = [len(x) for _, x, _ in usable]
    usual = max(sorted(set(sizes), reverse=True), key=sizes.count, default=0)
    usable = [r for r in usable if len(r[1]) == usual]
    out = []
    for i, (anchor, x, label) in enumerate(usable):
        if anchor % every:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y)), other, other_label) for j, (other, y, other_label) in enumerate(usable) if j != i]
        best = sorted((s, o) for s, o, other in scores if other == label)[:n_positives]
        for p, positive in best:
            window = sorted((s, o) for s, o, other in scores if other != label and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(anchor, positive, k + 1, o, -p, -s) for k, (s, o) in enumerate(window[:n_negatives])]
    return sorted(out)


def table(seed, n, size=12, labels=4, copies=0):
    draw = random.Random(seed)
    vectors = [[draw.gauss(0, 1) + (k == i % 4) for k in range(size)] for i in range(n)]
    rows = [(i, v, draw.randrange(labels)) for i, v in enumerate(vectors)]
    return rows + [(n + i, vectors[0], draw.randrange(2)) for i in range(copies)]


def mined(spark, rows, every=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0).collect())


@pytest.mark.parametrize("many", [False, True])
def test_against_plain_search(spark, monkeypatch, many):
    if many:  # several blocks and tiles
        for name, value in (("ANCHORS", 16), ("ROWS", 50), ("LEAST_ROWS", 30), ("TILE", 7)):
            monkeypatch.setattr(negatives, name, value)
    rows = table(1, 230, copies=70)
    found = mined(spark, rows)
    assert found == plain(rows) and len(found) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = table(2, 60)
    rows += [(None, rows[0][1], 1), (5, None, 1), (10, rows[1][1], None), (15, [nan] * 12, 1), (20, [inf] + [0.0] * 11, 2), (25, [None] + [0.0] * 11, 2)]
    rows += [(30, [1.0] * 3, 1), (35, [], 1), (40, [0.0] * 12, 1), rows[0], rows[0], rows[3]]
    assert mined(spark, rows) == plain(rows)


def test_equal_scores_take_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0], 0) for i in (0, 9, 4, 7)] + [(i, [0.75, 0.25], 1) for i in (8, 3, 11, 6, 2)]
    assert mined(spark, rows, every=20) == plain(rows, every=20)
    assert {r[3] for r in mined(spark, rows, every=20)} == {2, 3, 6}


def test_empty_and_clashing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    rows = table(4, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("x", "row", "anchor", "place", "score", "across", "down", "_parts"):
        df = df.withColumn(name, F.lit("clash"))
    assert sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0).collect()) == plain(rows)


@pytest.mark.parametrize("size,high", [(3, 5), (64, 300), (700, 40_000), (2, 2**30)])
def test_exact_products(size, high):
    draw = np.random.default_rng(size)
    a, b = (draw.integers(-high, high + 1, (n, size)) for n in (9, 13))
    a[0], b[0], b[1] = high, high, -high
    want = a.astype(object) @ b.astype(object).T
    chosen = negatives.moduli(int(abs(want).max()))
    found = negatives.exact_products(negatives.residues(a, chosen), negatives.residues(b, chosen), chosen)
    assert (found.astype(object) == want).all()


def test_moduli_are_exact_in_float32():
    assert negatives.BLOCK * (negatives.PRIME // 2) ** 2 <= 2**24
    assert math.prod(negatives.moduli(1 << 62)) > 1 << 63
