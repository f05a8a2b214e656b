"""Passages of benchmark items in documents.

A window as long as the item gets a SimHash fingerprint over its five-word
shingles. A multi-index of the items' fingerprints of that length, cut into
blocks, finds all of them within RADIUS bits: of so many differing bits some
block has few, and the tables hold every block value that near. Each candidate
is verified by the exact similarity of the shingles weighted by their counts.
A window that shares no shingle with any item of its length has similarity
zero, so fingerprints are made only for windows around shared shingles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import arrow_schema, small_batches, texts
from marquee.llm.licences import words

SHINGLE, SIMILAR, RADIUS = 5, 0.8, 24
# Bits that differ in expectation at the similarity: about 10 of 64, so that RADIUS leaves out next to none.
BLOCKS, BLOCK_BITS = 8, 8
# Characters of benchmark items that one pass over the documents searches for.
ITEM_CHARACTERS = 16_000_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def shingle_keys(ids: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of SHINGLE word numbers."""
    n = len(ids) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    wide, key = ids.astype(np.uint64) + np.uint64(1), np.zeros(n, dtype=np.uint64)
    for i in range(SHINGLE):
        key = (key ^ (wide[i : i + n] * _MIX[i])) * _MIX[(i + 1) % SHINGLE]
        key ^= key >> np.uint64(29)
    key *= _MIX[0]
    return key ^ (key >> np.uint64(32))


def window_prints(keys: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of `size` shingles: bits that more than half of them set."""
    bits = np.unpackbits(keys.astype(">u8").view(np.uint8)).reshape(-1, 64)
    sums = np.concatenate((np.zeros((1, 64), dtype=np.int64), bits.cumsum(axis=0, dtype=np.int64)))
    return np.packbits(2 * (sums[size:] - sums[:-size]) > size, axis=1)


def similarity(a: Counter, b: Counter) -> float:
    """Shared weight over joint weight of shingles weighted by their counts."""
    shared = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared)


class MultiIndex:
    """Fingerprints, as rows of bytes, that are found within RADIUS bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.radius = prints, radius
        within = radius // BLOCKS
        flips = [sum(1 << i for i in x) for k in range(within + 1) for x in combinations(range(BLOCK_BITS), k)]
        self.tables = np.zeros((BLOCKS, 1 << BLOCK_BITS, len(prints)), dtype=bool)
        for block in range(BLOCKS):
            for flip in flips:
                self.tables[block, prints[:, block] ^ flip, np.arange(len(prints))] = True

    def near(self, windows: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, place of the fingerprint, differing bits) of all pairs within the radius."""
        hit = self.tables[0, windows[:, 0]]
        for block in range(1, BLOCKS):
            hit = hit | self.tables[block, windows[:, block]]
        for w, item in zip(*np.nonzero(hit)):
            bits = int(np.bitwise_count(windows[w] ^ self.prints[item]).sum())
            if bits <= self.radius:
                yield int(w), int(item), bits


class Items:
    """Searchable benchmark items; those with fewer words than a shingle match nothing."""

    def __init__(self, rows: Sequence[tuple[int | None, str | None]], similar: float = SIMILAR, radius: int = RADIUS) -> None:
        self.similar = similar
        own = [(item, found) for item, text in rows if len(found := words(text)) >= SHINGLE]
        self.number: dict[bytes, int] = {}
        for _, found in own:
            for w in found:
                self.number.setdefault(w, len(self.number))
        sizes: dict[int, list[tuple[int | None, np.ndarray]]] = {}
        for item, found in own:
            sizes.setdefault(len(found) - SHINGLE + 1, []).append((item, self.keys(found)[0]))
        self.items, self.index, self.counts = {}, {}, {}
        for size, same in sizes.items():
            self.items[size] = [item for item, _ in same]
            self.index[size] = MultiIndex(np.concatenate([window_prints(k, size) for _, k in same]), radius)
            self.counts[size] = [Counter(k.tolist()) for _, k in same]
        pairs = sorted({(k, size) for size, same in self.counts.items() for c in same for k in c})
        self.shingles = np.array([k for k, _ in pairs], dtype=np.uint64)
        self.sizes = np.array([size for _, size in pairs], dtype=np.int64)

    def keys(self, found: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes of words, and which of them have only words of the items."""
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
        n = len(ids) - SHINGLE + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        inside = unknown[SHINGLE:] == unknown[:-SHINGLE]
        return shingle_keys(ids), inside

    def search(self, text: str | None) -> list[tuple[int | None, float, int, int, int]]:
        """(item, similarity, differing bits, first word, end) of the best window of each item found in a whole text."""
        found = words(text)
        if len(found) < SHINGLE or not len(self.shingles):
            return []
        keys, inside = self.keys(found)
        places = np.flatnonzero(inside)
        first = np.searchsorted(self.shingles, keys[places], "left")
        last = np.searchsorted(self.shingles, keys[places], "right")
        hits: dict[int, list[int]] = {}
        for place, a, b in zip(places[first < last].tolist(), first[first < last].tolist(), last[first < last].tolist()):
            for size in set(self.sizes[a:b].tolist()):
                hits.setdefault(size, []).append(place)
        if not hits:
            return []
        if not inside.all():
            # Words of no item share one number; two shingles with such words are no evidence, so each counts as its own.
            keys = np.where(inside, keys, np.arange(len(keys), dtype=np.uint64) * _MIX[1] ^ _MIX[2])
        best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
        for size, own in hits.items():
            for low, high in self._stretches(own, size, len(keys)):
                self._windows(keys[low:high], low, size, best)
        return [(self.items[size][i], *x) for (size, i), x in sorted(best.items())]

    @staticmethod
    def _stretches(places: list[int], size: int, n: int) -> Iterator[tuple[int, int]]:
        """Stretches of shingles that hold all windows around the places, joined where they meet."""
        low = high = None
        for place in places:
            a, b = max(0, place - size + 1), min(n, place + size)
            if low is None:
                low, high = a, b
            elif a <= high:
                high = b
            else:
                yield low, high
                low, high = a, b
        if low is not None:
            yield low, high

    def _windows(self, keys: np.ndarray, low: int, size: int, best: dict) -> None:
        width = min(size, len(keys))
        for w, item, bits in self.index[size].near(window_prints(keys, width)):
            window = Counter(keys[w : w + width].tolist())
            value = similarity(window, self.counts[size][item])
            known = best.get((size, item))
            if value >= self.similar and (known is None or value > known[0]):
                best[size, item] = (value, bits, low + w, low + w + width + SHINGLE - 1)


def item_blocks(items: DataFrame, characters: int = ITEM_CHARACTERS) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items in blocks of bounded size, one after another on the driver."""
    own = items.select(items["item_id"].cast("bigint").alias("item_id"), items["text"].cast("string").alias("text"))
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + 2 * total // characters
    for block in range(blocks):
        part = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct()
        yield [tuple(r) for r in part.orderBy("item_id", "text").collect()]


def find_leaks(docs: DataFrame, items: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Benchmark items found in documents, a row for each row of `docs` and item.

    Columns: doc_id, item_id, similarity, differing_bits, first_word, end_word (of the best window, leftmost if
    tied). A text with fewer words than the item is one window. Null and short texts or items match nothing;
    items of equal text are all reported; a repeated row is searched each time; empty tables give no rows.
    """
    schema = "doc_id bigint, item_id bigint, similarity double, differing_bits int, first_word bigint, end_word bigint"
    spark = docs.sparkSession
    small_batches(spark)
    kind, found = arrow_schema(spark, schema), None
    for block in item_blocks(items):
        index = Items(block, similar)

        def run(batches: Iterator[pa.RecordBatch], index: Items = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(i, *hit) for i, text in zip(*(c.to_pylist() for c in batch.columns)) for hit in index.search(text)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kind)], schema=kind)

        part = texts(docs).mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, items: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Rows of `docs` that hold no passage of an item, with all their columns."""
    small_batches(docs.sparkSession)
    place = docs.columns.index("text")
    for block in item_blocks(items):
        index = Items(block, similar)

        def run(batches: Iterator[pa.RecordBatch], index: Items = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not index.search(text) for text in batch.column(place).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
