"""Small documents for brute-force comparisons."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Random texts with copies, near copies, shared passages, blanks, nulls, repeated rows and long words."""
    draw = random.Random(seed)
    vocabulary = ["the", "of", "und", "élan", "naïve", "x", "a1", "Zürich", "wind", "river", "stone", "cloud", "paper", "light"]

    def words(k: int) -> str:
        return " ".join(draw.choice(vocabulary) + draw.choice(["", "", "s", "en", "ing", "."]) for _ in range(k))

    passage = words(60)
    found: list[tuple[int | None, str | None]] = []
    for i in range(n):
        lines = [words(draw.randrange(1, 30)) for _ in range(draw.randrange(1, 6))]
        if i % 7 == 0:
            lines.insert(draw.randrange(len(lines)), passage)
        found.append((100 - i, "\n".join(lines)))
    found += [(200 + i, found[i][1]) for i in range(0, n, 5)]
    found += [(300 + i, found[i][1].replace("river", "brook", 1)) for i in range(0, n, 6)]
    found += [(400, ""), (401, None), (402, "   \n\n "), (403, "word"), (404, "w" * 3000), (None, found[3][1]), (None, None), found[0], found[0]]
    return [(i, t, "en", "src", None if t is None else len(t)) for i, t in found]


def frame(spark, seed: int = 1, n: int = 60):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(3)


def clashing(spark, *names: str):
    """Documents with extra columns under the names that operators use themselves."""
    df = frame(spark)
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return frame(spark)


@pytest.fixture(scope="session")
def labels(spark):
    schema = "doc_id bigint, quality int, toxic int"
    known = [(i, i % 3 and 1, int(i % 4 == 0)) for i, *_ in rows() if i is not None]
    return spark.createDataFrame([*known, (None, 1, 1), (9999, None, None), (12345, 1, 0)], schema)
