"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary windows, one on what is
characteristic of toxic windows. A window of a text is compressed with the
ordinary dictionary and with the toxic one laid before it; the bytes that the
toxic dictionary saves are the window's gain. Both share the ordinary content at
the same distance, so an ordinary window is as long either way. The gains of all
windows give a document's numbers, and a logistic calibration turns them into a
score. Labels are learnt from only where `common.held_out` is false.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_schema, bounded_sample, held_out, per_text, small_batches, texts
from marquee.session import materialize

# Words in a window, and bytes at which a longer word is cut.
WINDOW_WORDS, LONG_WORD = 16, 256
# Bounds of what is learnt from: labelled documents and windows of each class for the dictionaries, rows for the calibration.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS, SAMPLE_ROWS = 3000, 20_000, 20_000
ORDINARY_BYTES, TOXIC_BYTES = 8192, 4096
# A word is characteristic if its first bytes are that many times as common in toxic windows, and seen that often.
STEM, RATIO, SEEN = 4, 8, 8
# Score from which a document counts as toxic.
TOXIC = 0.7
BINS = 1000
GAINS = ("mean_gain", "most_gain", "share_1", "share_2", "share_3", "count_2", "count_3", "top_gain", "least_gain")


def windows(text: str | None, size: int = WINDOW_WORDS) -> list[bytes]:
    """Every word of a whole text, ASCII in lower case, in windows of `size` words."""
    words = (text or "").encode().lower().split()
    if any(len(w) > LONG_WORD for w in words):
        words = [w[i : i + LONG_WORD] for w in words for i in range(0, len(w), LONG_WORD)]
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def characteristic(toxic: Sequence[bytes], ordinary: Sequence[bytes]) -> list[bytes]:
    """Toxic windows without the words whose beginnings ordinary windows have as well."""
    counts = [Counter(w[:STEM] for window in side for w in window.split()) for side in (toxic, ordinary)]
    total = [max(1, sum(c.values())) for c in counts]
    own = {s for s, n in counts[0].items() if n >= SEEN and n / total[0] > RATIO * (counts[1][s] + 1) / total[1]}
    cut = ([w for w in window.split() if w[:STEM] in own] for window in toxic)
    return [b" " + b" ".join(words) + b" " for words in cut if words]


def trained(samples: Sequence[bytes], size: int) -> bytes:
    """Content of a dictionary trained on samples; too few of them are the content themselves."""
    try:
        return zstandard.train_dictionary(size, list(samples)).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class Dictionaries:
    """Ordinary and toxic dictionary; empty where a class has no windows, and then nothing gains."""

    def __init__(self, toxic: Sequence[bytes], ordinary: Sequence[bytes]) -> None:
        own = characteristic(toxic, ordinary)
        # A few windows to a sample: the trainer wants samples longer than the segments it picks.
        joined = [b"".join(own[i : i + 8]) for i in range(0, len(own), 8)]
        self.ordinary = trained(ordinary, ORDINARY_BYTES) if ordinary else b""
        self.toxic = trained(joined, TOXIC_BYTES) if joined and ordinary else b""

    def gains(self, found: Sequence[bytes]) -> np.ndarray:
        """Bytes that each window saves with the toxic dictionary."""
        if not self.toxic or not found:
            return np.zeros(max(1, len(found)))
        plain, toxic = compressors(self.ordinary, self.toxic)
        return np.array([len(plain(w)) - len(toxic(w)) for w in found], dtype=float)


@lru_cache(maxsize=2)
def compressors(ordinary: bytes, toxic: bytes) -> tuple:
    """Compressors with searches deep enough to find the longest match, so that lengths differ only by content."""
    how = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=17, hash_log=15, chain_log=15, search_log=5,
        write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    made = []
    for content in (ordinary, toxic + ordinary):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=how)
        made.append(zstandard.ZstdCompressor(dict_data=known, compression_params=how).compress)
    return tuple(made)


def numbers(gains: np.ndarray) -> tuple[float, ...]:
    """GAINS of one document."""
    n = len(gains)
    counts = [int((gains >= least).sum()) for least in (1, 2, 3)]
    top = float(np.sort(gains)[-3:].mean())
    return (
        float(gains.mean()), float(gains.max()), *(c / n for c in counts),
        math.log1p(counts[1]), math.log1p(counts[2]), top, float(gains.min()),
    )


class Calibration:
    """Logistic weights on scaled numbers; without both classes every score is zero."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.weights = None
        if len(y) and 0 < y.sum() < len(y):
            self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
            z = self._scaled(x)
            weights = np.zeros(z.shape[1])
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
                slope = z.T @ (y - p) - 1e-4 * len(y) * weights
                step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-4 * len(y) * np.eye(len(weights)), slope)
                weights += step
                if np.abs(step).max() < 1e-9:
                    break
            self.weights = weights
        self.shift = 0.0

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(self._scaled(x) @ self.weights + self.shift, -30, 30)))

    def move(self, counts: list[tuple[int, int, int]]) -> None:
        """Shift the scores so that the best cut lies at TOXIC: the one with the highest F1 over (bin, label, rows)."""
        true, false = np.zeros(BINS + 1), np.zeros(BINS + 1)
        for place, label, n in counts:
            (true if label else false)[place] += n
        caught, wrong = true[::-1].cumsum()[::-1], false[::-1].cumsum()[::-1]
        if self.weights is not None and true.sum():
            f1 = 2 * caught / (true.sum() + caught + wrong + 1e-9)
            best = np.flatnonzero(f1[1:BINS] >= f1[1:BINS].max() - 1e-12) + 1
            cut = (best[0] + best[-1]) / 2 / BINS
            self.shift += math.log(TOXIC / (1 - TOXIC)) - math.log(cut / (1 - cut))


def learnt_labels(labels: DataFrame) -> DataFrame:
    """Labels of rows that may be learnt from; a doc_id with several labels is toxic if one says so."""
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    return known.dropna().filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def train_dictionaries(docs: DataFrame, known: DataFrame) -> Dictionaries:
    """From at most SAMPLE_WINDOWS windows of SAMPLE_DOCUMENTS labelled documents of each class."""
    small_batches(docs.sparkSession)
    sides = [bounded_sample(known.filter(F.col("toxic") == label), "doc_id", SAMPLE_DOCUMENTS) for label in (1, 0)]
    # The sample has a fixed number of rows, so it may be broadcast whatever the size of the table.
    sample = texts(docs).join(F.broadcast(sides[0].unionByName(sides[1])), "doc_id").select("toxic", "text")
    schema = "toxic int, piece binary"
    kind = arrow_schema(docs.sparkSession, schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(label, w) for label, text in zip(*(c.to_pylist() for c in batch.columns)) for w in windows(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kind)], schema=kind)

    pieces = materialize(sample.mapInArrow(cut, schema), "windows")
    found = [
        [bytes(r["piece"]) for r in bounded_sample(pieces.filter(F.col("toxic") == label), "piece", SAMPLE_WINDOWS).collect()]
        for label in (1, 0)
    ]
    return Dictionaries(*found)


class Model(NamedTuple):
    """Dictionaries and the calibration of what they save."""

    pair: Dictionaries
    calibration: Calibration

    def scores(self, whole: list[str | None]) -> np.ndarray:
        found = [numbers(self.pair.gains(windows(text))) for text in whole]
        return self.calibration.score(np.array(found).reshape(-1, len(GAINS)))


def gains_of(docs: DataFrame, pair: Dictionaries) -> DataFrame:
    def rows(ids: list, whole: list) -> dict:
        found = [numbers(pair.gains(windows(text))) for text in whole]
        return {"doc_id": ids} | {name: [f[i] for f in found] for i, name in enumerate(GAINS)}

    return per_text(docs, "doc_id bigint, " + ", ".join(f"{name} double" for name in GAINS), rows)


def calibrated(read: DataFrame, known: DataFrame) -> Calibration:
    """Weights from at most SAMPLE_ROWS labelled rows, the cut from the score bins of all of them."""
    labelled = read.join(known, "doc_id")
    sample = bounded_sample(labelled, "doc_id", SAMPLE_ROWS, *GAINS).select("toxic", *GAINS).collect()
    table = np.array([tuple(r) for r in sample], dtype=float).reshape(-1, 1 + len(GAINS))
    calibration = Calibration(table[:, 1:], table[:, 0])
    bins = with_scores(labelled, calibration, ["toxic"]).groupBy(F.floor(F.col("score") * BINS).alias("place"), "toxic")
    calibration.move([(r["place"], r["toxic"], r["n"]) for r in bins.agg(F.count("*").alias("n")).collect()])
    return calibration


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every whole text, a row for each row.

    Columns: doc_id, held_out, score (0 to 1), predicted (1 from TOXIC on). A null or empty text has one window
    without gain; a null doc_id is not held out. Labels that are null or have no document are not used. Without
    labels of both classes every score is 0; an empty table gives an empty result.
    """
    known = learnt_labels(labels)
    read = materialize(gains_of(docs, train_dictionaries(docs, known)), "gains")
    scored = with_scores(read, calibrated(read, known), ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs` that are not toxic, with all their columns.

    The model is fitted as for `score_toxicity`; then each text is compressed again where it is kept or dropped,
    which costs less than to shuffle texts to their scores."""
    known = learnt_labels(labels)
    pair = train_dictionaries(docs, known)
    model = Model(pair, calibrated(materialize(gains_of(docs, pair), "gains"), known))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(place).to_pylist()) < TOXIC))

    return docs.mapInArrow(run, docs.schema)


def with_scores(rows: DataFrame, calibration: Calibration, keep: list[str]) -> DataFrame:
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.select(*keep).dtypes) + ", score double"
    kind = arrow_schema(rows.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in GAINS])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(calibration.score(x), pa.float64())], schema=kind)

    return rows.select(*keep, *GAINS).mapInArrow(run, schema)
