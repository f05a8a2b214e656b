"""Quality rules over text statistics, and an isolation forest that rejects anomalous documents.

One pass counts the rule statistics of every whole text. Trees are grown over a
bounded sample of labelled good rows; a document that random splits isolate
early has short paths and a high score. The threshold comes from the scores of
all labelled rows, which reach the driver as counts in fixed bins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_schema, bounded_sample, per_text
from marquee.session import materialize

# Trees, rows in a tree, and the bound of the labelled sample that they are drawn from.
TREES, TREE_ROWS, SAMPLE_ROWS, SEED = 100, 1024, 25_600, 7
# Of the labelled good rows that pass the base rules, at most this share may be rejected.
GOOD_REJECTED = 0.002
BINS = 2000
# Splits reach this far beyond a sample's range at least: a rate that is the same in all good rows still isolates others.
MARGIN = 0.01

_SPACES, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
STATISTICS = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_types bigint"


def repeated_words(ids: np.ndarray, types: int) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * types + ids[1:]
    if types > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, place, n = np.unique(pairs[:-1] * types + ids[2:], return_inverse=True, return_counts=True)
    again = n[place] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def statistics_of(text: str | None) -> tuple[int, ...]:
    """The numbers of STATISTICS after the id."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines, again, seen = 0, 0, set()
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                again += 1
            seen.add(line)
    spaces = len(raw) - len(raw.translate(None, _SPACES))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return len(words), len(text) - spaces, symbols, again, repeated_words(ids, len(number)), lines, len(number)


def text_statistics(docs: DataFrame) -> DataFrame:
    """Rule statistics of every whole text, a row for each row; a null text has no words."""

    names = [x.split()[0] for x in STATISTICS.split(", ")][1:]

    def rows(ids: list, whole: list) -> dict:
        return {"doc_id": ids} | dict(zip(names, zip(*map(statistics_of, whole)))) if ids else {n: [] for n in ("doc_id", *names)}

    return per_text(docs, STATISTICS, rows)


FEATURES = ("symbol_rate", "dup_line_rate", "repeat_rate", "word_length", "type_rate")


def features() -> list:
    """FEATURES: rates that do not grow with the length of a text."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return [
        (F.col("n_symbols") / F.greatest("word_chars", F.lit(1))).alias("symbol_rate"),
        (F.col("n_dup_lines") / lines).alias("dup_line_rate"),
        (F.col("n_repeat_words") / words).alias("repeat_rate"),
        (F.col("word_chars") / words).alias("word_length"),
        (F.col("n_types") / words).alias("type_rate"),
    ]


def mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class Forest:
    """Trees of random splits over a sample; too few rows give a forest that rejects nothing."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> None:
        draw = np.random.default_rng(seed)
        self.unit = mean_path(min(rows, len(sample)))
        self.trees = []
        for _ in range(trees if len(sample) > 1 else 0):
            own = sample[draw.choice(len(sample), min(rows, len(sample)), replace=False)]
            self.trees.append(self._grow(own, draw, math.ceil(math.log2(len(own)))))

    @staticmethod
    def _grow(sample: np.ndarray, draw: np.random.Generator, depth: int) -> tuple[np.ndarray, ...]:
        feature, split, left, path = [], [], [], []

        def node() -> int:
            feature.append(-1), split.append(0.0), left.append(0), path.append(0.0)
            return len(feature) - 1

        queue = [(node(), sample, 0)]
        while queue:
            at, own, level = queue.pop()
            if level == depth or len(own) < 2:
                path[at] = level + mean_path(len(own))
                continue
            feature[at] = int(draw.integers(sample.shape[1]))
            values = own[:, feature[at]]
            margin = max(MARGIN, (values.max() - values.min()) / 4)
            split[at] = float(draw.uniform(values.min() - margin, values.max() + margin))
            left[at] = node()
            node()
            below = values <= split[at]
            queue += [(left[at], own[below], level + 1), (left[at] + 1, own[~below], level + 1)]
        return np.array(feature), np.array(split), np.array(left), np.array(path)

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path over the mean of a random tree: near 1 is anomalous."""
        total = np.zeros(len(x))
        for feature, split, left, path in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while (inner := feature[at] >= 0).any():
                own = at[inner]
                at[inner] = left[own] + (x[inner, feature[own]] > split[own])
            total += path[at]
        return np.exp2(-total / max(1, len(self.trees)) / max(self.unit, 1e-9)) if self.trees else np.zeros(len(x))


def with_scores(rows: DataFrame, forest: Forest) -> DataFrame:
    """STATISTICS with the forest's score."""
    schema = rows.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", score double"
    kind = arrow_schema(rows.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in FEATURES])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(x), pa.float64())], schema=kind)

    return rows.mapInArrow(run, schema)


def threshold(counts: list[tuple[int, int, int]], good_rejected: float = GOOD_REJECTED) -> float:
    """Lowest score to reject from (bin, quality, rows): the cut that tells the labels best apart
    among those that reject no more good rows than allowed. Without labels nothing is rejected."""
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for place, quality, n in counts:
        (good if quality else bad)[place] += n
    if not bad.sum() or not good.sum():
        return math.inf
    from_here = lambda x: x[::-1].cumsum()[::-1] / x.sum()
    caught, lost = from_here(bad), from_here(good)
    gain = np.where(lost <= good_rejected, caught - lost, -1.0)
    best = int(gain.argmax())
    return best / BINS if gain[best] > 0 else math.inf


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Keep or reject every document.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score.
    A null or empty text has no words and so fails the base rules. Labels that are null, or whose doc_id
    has no document, are not used; a doc_id labelled twice counts twice, and every row of a repeated doc_id
    is judged by itself. Without labels, or with an empty table, only the base rules decide.
    """
    spark = docs.sparkSession
    rows = materialize(text_statistics(docs).select("*", *features()), "statistics")
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels["quality"].cast("int").alias("quality")).dropna()
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    labelled = rows.filter(~failed).join(known, "doc_id")
    sample = bounded_sample(labelled.filter("quality = 1"), "doc_id", SAMPLE_ROWS, *FEATURES).select(*FEATURES)
    forest = Forest(np.array([tuple(r) for r in sample.collect()], dtype=float).reshape(-1, len(FEATURES)))
    bins = with_scores(labelled, forest).groupBy(F.floor(F.col("score") * BINS).alias("place"), "quality").agg(F.count("*").alias("n"))
    limit = threshold([(r["place"], r["quality"], r["n"]) for r in bins.collect()])
    return with_scores(rows, forest).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("score") < F.lit(limit))).alias("kept"), "score",
    )
