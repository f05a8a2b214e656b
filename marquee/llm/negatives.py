"""Hard negatives by exact integer scores, computed modulo small primes in float32.

Vectors of whole numbers are reduced modulo primes so small that a float32 matrix product of BLOCK dimensions is exact;
as many primes are taken as the lengths of the vectors ask for, and the signed scores are put together again by Chinese
remaindering, in balanced mixed-radix digits. Anchors and rows are dealt to blocks of bounded size by a hash of the
row, so neither a common label nor a common vector makes a block larger, and every anchor block meets every row block
in one task. A first pass finds the positives of each anchor, which give each its window of scores; a second one keeps
the best rows in every window. What the blocks find is merged by a window that keeps a few rows for each key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import arrow_schema
from marquee.llm.vectors import whole_vectors
from marquee.session import materialize

# Dimensions multiplied in one float32 product, and the bound of the primes: BLOCK * (PRIME / 2) ** 2 is below 2 ** 24.
BLOCK, PRIME = 256, 512
# Anchors and rows of one block, and of the tile of scores that a task holds at a time.
ANCHORS, ROWS, TILE = 16_384, 65_536, 2_048
# A small table is cut finer, so that all cores have work.
LEAST_ROWS = 2_048
# Components below this many units have scores that fit a long, up to LONGEST squared units in all.
UNITS, LONGEST = 1 << 31, 1 << 62
NONE = -(1 << 63) + 1


@lru_cache(maxsize=1)
def primes() -> list[int]:
    """Odd primes below PRIME, the largest first."""
    return [p for p in range(PRIME - 1, 2, -1) if all(p % q for q in range(2, isqrt(p) + 1))]


def moduli(most: int) -> list[int]:
    """As many primes as tell all whole numbers from -most to most apart."""
    chosen, product = [], 1
    for p in primes():
        if product > 2 * most:
            break
        chosen.append(p)
        product *= p
    return chosen


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers, exact as doubles, to their residues from -(p-1)/2 to (p-1)/2."""
    return x - p * np.rint(x / p)


def residues(x: np.ndarray, chosen: list[int]) -> list[np.ndarray]:
    """The float32 component matrices of a matrix of longs."""
    return [((x + p // 2) % p - p // 2).astype(np.float32) for p in chosen]


def exact_products(a: list[np.ndarray], b: list[np.ndarray], chosen: list[int]) -> np.ndarray:
    """The matrix of signed inner products of the rows behind two sets of component matrices."""
    digits: list[np.ndarray] = []
    weight, total = 1, None
    for i, p in enumerate(chosen):
        x, y, rest = a[i], b[i], None
        for at in range(0, x.shape[1], BLOCK):
            part = (x[:, at : at + BLOCK] @ y[:, at : at + BLOCK].T).astype(np.float64)
            rest = part if rest is None else rest + part
        digit = _balanced(rest, p)
        for q, known in zip(chosen, digits):
            digit = _balanced((digit - known) * pow(q, -1, p), p)
        digits.append(digit)
        # Sums of longs wrap around, and what they wrap to is right, as the score itself fits.
        term = digit.astype(np.int64) * np.array(weight % (1 << 64), np.uint64).astype(np.int64)
        total = term if total is None else total + term
        weight *= p
    return total


class Block:
    """Rows of one block: names, labels and vectors, ordered by `order`."""

    def __init__(self, table: pa.Table, *order: str) -> None:
        whole = table.select(["row", "vec_id", "label"]).to_pydict()
        columns = {k: np.array(v, np.int64) for k, v in whole.items()}
        at = np.lexsort([columns[name] for name in reversed(order)])
        self.at, self.row, self.vec_id, self.label = at, columns["row"][at], columns["vec_id"][at], columns["label"][at]
        lists = table.column("x").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.x = flat.reshape(len(at), -1)[at]
        self.squares = max((int(s) for s in (self.x.astype(np.float64) ** 2).sum(axis=1)), default=0)

    def __len__(self) -> int:
        return len(self.row)


def _chosen(a: Block, b: Block) -> list[int]:
    """Primes for the scores of two blocks: no score is beyond the product of the longest vectors' lengths."""
    return moduli((isqrt(a.squares) + 2) * (isqrt(b.squares) + 2))


def _leaders(scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The best `most` scores of each row and where they stand, the earlier of equal ones first; `scores` is used up."""
    lines = np.arange(len(scores))
    values, places = [], []
    for _ in range(most):
        place = scores.argmax(axis=1)
        values.append(scores[lines, place])
        places.append(place)
        scores[lines, place] = NONE
    return np.stack(values, 1), np.stack(places, 1)


def _better(best: tuple, values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge leaders of a later tile into those of the earlier ones, which come first where scores are equal."""
    if best is None:
        return values, places
    all_values, all_places = np.concatenate([best[0], values], 1), np.concatenate([best[1], places], 1)
    order = np.argsort(-all_values, axis=1, kind="stable")[:, : values.shape[1]]
    return np.take_along_axis(all_values, order, 1), np.take_along_axis(all_places, order, 1)


def _tiles(n: int) -> Iterator[slice]:
    return (slice(at, min(at + TILE, n)) for at in range(0, n, TILE))


def positives_of(anchors: Block, rows: Block, most: int) -> dict[str, np.ndarray]:
    """For each anchor the best rows of its own label in this block, itself left out. Both blocks are ordered by label."""
    chosen = _chosen(anchors, rows)
    parts = residues(rows.x, chosen)
    found = []
    for label in np.unique(anchors.label):
        first, last = np.searchsorted(anchors.label, [label, label + 1])
        low, high = np.searchsorted(rows.label, [label, label + 1])
        for own in _tiles(last - first):
            own = slice(first + own.start, first + own.stop)
            mine, best = residues(anchors.x[own], chosen), None
            for tile in _tiles(high - low):
                tile = slice(low + tile.start, low + tile.stop)
                scores = exact_products(mine, [p[tile] for p in parts], chosen)
                scores[anchors.row[own][:, None] == rows.row[tile][None, :]] = NONE
                values, places = _leaders(scores, min(most, scores.shape[1]))
                pad = ((0, 0), (0, most - values.shape[1]))
                best = _better(best, np.pad(values, pad, constant_values=NONE), np.pad(places + tile.start, pad))
            if best is not None:
                line, rank = np.nonzero(best[0] > NONE)
                found.append((anchors.row[own][line], anchors.vec_id[own][line], rows.vec_id[best[1][line, rank]], rows.row[best[1][line, rank]], best[0][line, rank]))
    names = ["anchor", "anchor_id", "positive_id", "positive", "score"]
    return {n: np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i, n in enumerate(names)}


def negatives_of(anchors: Block, rows: Block, low: np.ndarray, high: np.ndarray, most: int) -> dict[str, np.ndarray]:
    """For each anchor and place the best rows of other labels with a score from `low` to `high`; rows ordered by id."""
    chosen = _chosen(anchors, rows)
    parts = residues(rows.x, chosen)
    found = []
    for own in _tiles(len(anchors)):
        mine = residues(anchors.x[own], chosen)
        best: list = [None] * low.shape[1]
        for tile in _tiles(len(rows)):
            scores = exact_products(mine, [p[tile] for p in parts], chosen)
            scores[anchors.label[own][:, None] == rows.label[tile][None, :]] = NONE
            for place in range(low.shape[1]):
                inside = (scores >= low[own, place, None]) & (scores <= high[own, place, None])
                values, places = _leaders(np.where(inside, scores, NONE), min(most, scores.shape[1]))
                pad = ((0, 0), (0, most - values.shape[1]))
                best[place] = _better(best[place], np.pad(values, pad, constant_values=NONE), np.pad(places + tile.start, pad))
        for place, (values, places) in enumerate(b for b in best if b is not None):
            line, rank = np.nonzero(values > NONE)
            found.append((anchors.row[own][line], np.full(len(line), place), rows.vec_id[places[line, rank]], values[line, rank]))
    names = ["anchor", "place", "negative_id", "negative_score"]
    return {n: np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i, n in enumerate(names)}


def _grid(anchors: DataFrame, rows: DataFrame, schema: str, found: Callable[[pa.Table, pa.Table], dict]) -> DataFrame:
    """`found` of every anchor block with every row block; the copies of a block are as many as the other side's blocks."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_anchors, n_rows = anchors.count(), rows.count()
    across = max(1, -(-n_anchors // ANCHORS))
    down = max(1, -(-n_rows // ROWS), min(-(-n_rows // LEAST_ROWS), -(-tasks // across)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select("*", dealt(across).alias("across"), every(down).alias("down"))
    # Both sides come from one table: new names tell their columns apart.
    right = rows.select("*", every(across).alias("across"), dealt(down).alias("down")).toDF(*rows.columns, "across", "down")
    kind = arrow_schema(spark, schema)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        columns = found(a, b) if a.num_rows and b.num_rows else {f.name: [] for f in kind}
        return pa.table([pa.array(columns[f.name], f.type) for f in kind], schema=kind)

    return left.groupBy("across", "down").cogroup(right.groupBy("across", "down")).applyInArrow(run, schema)


def hard_negatives(
    rows: DataFrame, anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 3,
    least: tuple[int, int] = (1, 2), most: tuple[int, int] = (19, 20),
) -> DataFrame:
    """Mine hard negatives from rows of vec_id, label and embedding.

    A component counts as floor(scale * component); a score is the inner product with the anchor. `anchor` says which
    rows are anchors; the positives of an anchor are its best other rows of the same label, by score, then by the
    smaller vec_id. For each of them come the best rows of other labels whose score is between the fractions `least`
    and `most` of the positive's, both included. Columns: anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score; an anchor without positives, or a positive without such rows, has none.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part, nor do vectors of
    another length than most (`vectors.whole_vectors`) or so long that scores would not fit a long. Rows equal in all
    columns are rows of their own: each is an anchor, and each may be a positive or negative of the other. Other columns
    are not looked at; an empty table gives an empty result.
    """
    named = [rows["vec_id"].cast("bigint").alias("vec_id"), rows["label"].cast("bigint").alias("label"), anchor.alias("anchor")]
    whole = whole_vectors(rows, scale, UNITS, *named).filter("vec_id is not null and label is not null")
    length = F.aggregate("x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    short = whole.filter(length < float(LONGEST)).withColumn("x", F.col("x").cast("array<int>"))
    known = materialize(short.withColumn("row", F.monotonically_increasing_id()), "whole-vectors")
    anchors, others = known.filter("anchor").drop("anchor"), known.drop("anchor")

    def best_positives(a: pa.Table, b: pa.Table) -> dict:
        return positives_of(Block(a, "label", "row"), Block(b, "label", "vec_id", "row"), positives)

    schema = "anchor bigint, anchor_id bigint, positive_id bigint, positive bigint, score bigint"
    some = _grid(anchors, others, schema, best_positives)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id", "positive")
    kept = some.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    pairs = materialize(kept.select("anchor", "anchor_id", (F.col("place") - 1).alias("place"), "positive_id", "score"), "positives")

    # The scores of an anchor's positives in their order: a few for each.
    windows = pairs.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("scores"))
    windowed = anchors.join(windows.withColumnRenamed("anchor", "row"), "row").withColumn("scores", F.col("scores.score"))

    def best_negatives(a: pa.Table, b: pa.Table) -> dict:
        block = Block(a, "row")
        bounds = a.column("scores").to_pylist()
        low, high = (np.full((len(block), positives), fill, np.int64) for fill in (1, 0))
        for line, at in enumerate(block.at):
            for place, score in enumerate(bounds[at]):
                low[line, place], high[line, place] = -(-score * least[0] // least[1]), score * most[0] // most[1]
        return negatives_of(block, Block(b, "vec_id", "row"), low, high, negatives)

    schema = "anchor bigint, place int, negative_id bigint, negative_score bigint"
    some = _grid(windowed, others, schema, best_negatives)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.join(pairs.withColumnRenamed("score", "positive_score"), ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
