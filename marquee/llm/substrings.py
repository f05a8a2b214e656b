"""Removal of repeated byte strings by suffix arrays of shards.

Every window of LENGTH bytes has a key, the least hash of its GRAM-byte strings,
which equal windows share wherever they stand. Runs of windows with one key are
segments. A first pass finds the keys that occur in more than one document; a
second pass sends the segments with such keys, each distinct text once per task,
to the shard of the key. A shard orders the suffixes of its segments by external
induced sorting (`suffixes`), neighbours that agree on LENGTH bytes are one
window, and the smallest document of a window keeps it. Shards see who has a
segment only as its smallest and largest document: they tell each task's pack
which runs of windows have which keeper, and the occurrences, however many a hot
passage has, stay with their pack and look their ranges up there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marquee.llm.common import arrow_schema, small_batches, texts
from marquee.llm.suffixes import equal_groups, suffix_order
from marquee.session import materialize

LENGTH, GRAM = 50, 24
# Bits of the set of shared keys that is sent to every task. Its size is fixed: once it is full it holds fewer
# segments back, and no shared one ever.
FILTER_BITS = 1 << 27
# Keys, or bytes of segments, that a task holds before it hands them on.
HELD_KEYS, HELD_BYTES = 1 << 22, 1 << 25
# Least route of rows that are for no shard: more than there are shards.
AWAY = 1 << 30
# Occurrences whose ranges are made at once.
OCCURRENCES = 1 << 16
# Columns of a pack that go to the shards, and those that are dealt evenly and wait for what the shards tell.
SEGMENTS = ["pack", "shard", "keys", "sizes", "bytes", "least", "most"]
HOLDERS = ["pack", "shard", "segment", "doc", "start", "doc_ids", "text_hashes"]

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _rolled(values: np.ndarray, size: int, join) -> np.ndarray:
    """`join` over each run of `size` neighbours, by runs of doubling length."""
    whole, at, part, step = None, 0, values, 1
    while size:
        if size & 1:
            if whole is None:
                whole = part
            else:
                n = len(part) - at
                whole = join(whole[:n], part[at : at + n])
            at += step
        size >>= 1
        if size:
            part = join(part[:-step], part[step:])
            step *= 2
    return whole


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a ^ (a >> np.uint64(29))) * _B) + b


def window_keys(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Key of the window that starts at each byte; `data` is at least `length` bytes."""
    hashes = _rolled((data.astype(np.uint64) + np.uint64(1)) * _A, gram, _mix)
    hashes = (hashes ^ (hashes >> np.uint64(32))) * _A
    hashes ^= hashes >> np.uint64(29)
    return _rolled(hashes, length - gram + 1, np.minimum)


def segments(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first windows and numbers of windows of the segments of a text."""
    if len(raw) < length:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    keys = window_keys(np.frombuffer(raw, dtype=np.uint8), length, gram)
    starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return keys[starts], starts, np.diff(np.append(starts, len(keys)))


# The keys are least hashes, so their upper bits are mostly zero; they are spread before they are dealt out.
def spread(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * _B
    return keys ^ (keys >> np.uint64(33))


def _shards(docs: DataFrame) -> int:
    """A power of two of several shards for each shuffle partition, so that shards stay small as partitions do."""
    return 1 << max(6, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length() + 2)


def _dealt(spark, rows: DataFrame, key: str = "shard") -> DataFrame:
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, key).sortWithinPartitions(key)


def shared_keys(docs: DataFrame, shards: int) -> np.ndarray:
    """Set, as bits, of the keys that occur in at least two documents."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = "shard int, once binary, again binary"
    kind = arrow_schema(spark, schema)
    shift = np.uint64(64 - shards.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            for text in batch.column(1).to_pylist():
                keys = np.unique(spread(segments((text or "").encode())[0]))
                held.append(keys)
                n += len(keys)
            if n > HELD_KEYS:
                yield dealt(held)
                held, n = [], 0
        yield dealt(held)

    def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, times = np.unique(np.concatenate([*held, np.zeros(0, dtype=np.uint64)]), return_counts=True)
        cuts = np.searchsorted(keys >> shift, np.arange(shards + 1, dtype=np.uint64))
        rows = []
        for shard in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            own, more = keys[cuts[shard] : cuts[shard + 1]], times[cuts[shard] : cuts[shard + 1]] > 1
            rows.append((shard, own[~more].tobytes(), own[more].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kind)], schema=kind)

    # A shard owns a stretch of the bits, as it does of the keys.
    per_shard = FILTER_BITS // shards
    found_schema = "shard int, bits binary"
    found_kind = arrow_schema(spark, found_schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in by_shard(batches):
            once = np.sort(np.concatenate([np.frombuffer(r["once"], dtype=np.uint64) for r in rows]))
            twice = [once[1:][once[1:] == once[:-1]], *(np.frombuffer(r["again"], dtype=np.uint64) for r in rows)]
            # A key told as repeated by one task counts, whatever the others say.
            bits = np.zeros(per_shard, dtype=bool)
            both = np.concatenate(twice)
            bits[filter_places(both) - shard * per_shard] = True
            yield pa.RecordBatch.from_pydict({"shard": [shard], "bits": [np.packbits(bits).tobytes()]}, schema=found_kind)

    told = _dealt(spark, texts(docs).mapInArrow(count, schema)).mapInArrow(gather, found_schema)
    every = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in told.toLocalIterator():
        at = row["shard"] * per_shard // 8
        every[at : at + per_shard // 8] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return every


def filter_places(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - FILTER_BITS.bit_length() + 1)).astype(np.int64)


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each shard from batches that are sorted by it."""
    shard, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard and held:
                yield shard, held
                held = []
            shard = row["shard"]
            held.append(row)
    if held:
        yield shard, held


def send_segments(docs: DataFrame, shards: int, bits: np.ndarray) -> DataFrame:
    """Segments whose keys may be shared, packed by task and shard: a row for each distinct segment once, whose route is
    the shard, and a row for who has it where, whose route is any."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(bits)  # FILTER_BITS / 8 bytes, always
    schema = (
        "route int, pack bigint, shard int, keys binary, sizes binary, bytes binary, least binary, most binary, segment binary, "
        "doc binary, start binary, doc_ids binary, text_hashes binary"
    )
    kind = arrow_schema(spark, schema)
    shift = np.uint64(64 - shards.bit_length() + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pack = Packing(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode()
                keys, starts, counts = segments(raw)
                keys = spread(keys)
                places = filter_places(keys)
                near = known.value[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1
                own = np.flatnonzero(near)
                if len(own):
                    held.add(doc_id, raw, keys[own], starts[own], counts[own], shift)
            if held.size > HELD_BYTES:
                yield held.packed(kind, pack)
                held, pack = Packing(), pack + 1
        yield held.packed(kind, pack)

    return texts(docs).mapInArrow(send, schema)


def coded(values: np.ndarray) -> bytes:
    """Steps from value to value, the bytes of one place together: what mostly repeats or counts up compresses well."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def decoded(raw: bytes, kind: type) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


class Packing:
    """Segments that a task holds, by shard."""

    def __init__(self) -> None:
        self.size, self.shards = 0, {}

    def add(self, doc_id: int | None, raw: bytes, keys: np.ndarray, starts: np.ndarray, counts: np.ndarray, shift: np.uint64) -> None:
        text_hash = xxh64_intdigest(raw, 42)
        who = (NO_ID if doc_id is None else doc_id, text_hash - (text_hash >> 63 << 64))
        for key, shard, a, n in zip(keys.tolist(), (keys >> shift).tolist(), starts.tolist(), counts.tolist()):
            box = self.shards.get(shard)
            if box is None:
                box = self.shards[shard] = ({}, [], [], [], {})
            known, segment, doc, start, docs = box
            piece = (key, raw[a : a + n + LENGTH - 1])
            number = known.setdefault(piece, len(known))
            self.size += 24 + (len(piece[1]) if number == len(known) - 1 else 0)
            segment.append(number)
            doc.append(docs.setdefault(who, len(docs)))
            start.append(a)

    def packed(self, kind: pa.Schema, pack: int) -> pa.RecordBatch:
        rows = []
        for shard, (known, segment, doc, start, docs) in self.shards.items():
            who = np.array([d for d, _ in docs], dtype=np.int64)[np.array(doc, dtype=np.int64)]
            least, most = np.full(len(known), NO_ID, dtype=np.int64), np.full(len(known), -NO_ID - 1, dtype=np.int64)
            np.minimum.at(least, segment, who)
            np.maximum.at(most, segment, who)
            rows.append((
                shard,
                pack,
                shard,
                np.array([k for k, _ in known], dtype=np.uint64).tobytes(),
                np.array([len(b) for _, b in known], dtype=np.uint32).tobytes(),
                b"".join(b for _, b in known),
                coded(least),
                coded(most),
                *[None] * 5,
            ))
            # Routes beyond those of the shards, spread whatever the shard.
            rows.append((
                AWAY + xxh64_intdigest(f"{pack} {shard}") % AWAY,
                pack,
                shard,
                *[None] * 5,
                coded(np.array(segment, dtype=np.uint32)),
                coded(np.array(doc, dtype=np.uint32)),
                coded(np.array(start, dtype=np.uint32)),
                coded(np.array([d for d, _ in docs], dtype=np.int64)),
                np.array([h for _, h in docs], dtype=np.int64).tobytes(),
            ))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kind)], schema=kind)


# Stands for a null id: larger than any other, so that such a document never keeps what another one has.
NO_ID = (1 << 63) - 1


class Shard:
    """All segments of a shard: each distinct one once, with its smallest document, and which pack has which."""

    def __init__(self) -> None:
        self._number: dict[tuple[int, bytes], int] = {}
        self._packs: list[tuple[int, np.ndarray, np.ndarray]] = []
        self._least: list[np.ndarray] = []

    def add(self, row: dict) -> None:
        """Segments of a pack; of one that is known already, only its number is held again."""
        keys, sizes = np.frombuffer(row["keys"], np.uint64).tolist(), np.frombuffer(row["sizes"], np.uint32)
        ends = np.cumsum(sizes, dtype=np.int64).tolist()
        own = [self._number.setdefault((k, row["bytes"][e - s : e]), len(self._number)) for k, e, s in zip(keys, ends, sizes.tolist())]
        self._packs.append((row["pack"], np.array(own, dtype=np.int64), decoded(row["most"], np.int64)))
        self._least.append(decoded(row["least"], np.int64))

    def close(self) -> None:
        self.keys = np.array([k for k, _ in self._number], dtype=np.uint64)
        self.pieces = [b for _, b in self._number]
        self.least = np.full(len(self._number), NO_ID, dtype=np.int64)
        for (_, own, _), least in zip(self._packs, self._least):
            np.minimum.at(self.least, own, least)

    def keepers(self) -> tuple[np.ndarray, np.ndarray]:
        """Smallest document of every window of every segment, and where the segments' windows begin among them."""
        sizes = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))
        windows = sizes - LENGTH + 1
        firsts = np.concatenate(([0], np.cumsum(windows)))
        keepers = np.repeat(self.least, windows)
        # A segment that is alone with its key has no other windows to be compared with.
        _, group, alike = np.unique(self.keys, return_inverse=True, return_counts=True)
        several = np.flatnonzero(alike[group] > 1)
        if len(several):
            raw = b"\0".join(self.pieces[i] for i in several.tolist())
            # Each segment starts after a mark that no byte of a text equals once bytes count from 1.
            joined = np.frombuffer(raw, dtype=np.uint8).astype(np.int16) + 1
            begins = np.concatenate(([0], np.cumsum(sizes[several] + 1)))
            joined[begins[1:-1] - 1] = 0
            joined = np.append(joined, np.int16(0))
            order = suffix_order(joined, LENGTH)
            place = np.full(len(joined), -1, dtype=np.int64)
            own = np.repeat(begins[:-1] - (firsts[several] - 0), windows[several])
            window = np.concatenate([np.arange(firsts[i], firsts[i + 1]) for i in several.tolist()])
            place[window + own] = window
            order = order[place[order] >= 0]
            same = equal_groups(np.frombuffer(raw + bytes(8), dtype=np.uint8), order, LENGTH)
            least = np.minimum.reduceat(keepers[place[order]], np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1]))))
            keepers[place[order]] = least[same]
        return keepers, firsts

    def runs(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """For each pack, runs of windows of its segments that a smaller document than one of the pack's has: number of
        the segment in the pack, first window, number of windows, keeper. A pack without any is left out."""
        self.close()
        keepers, firsts = self.keepers()
        change = np.concatenate(([True], keepers[1:] != keepers[:-1]))
        change[firsts[:-1]] = True
        begins = np.flatnonzero(change)
        sizes = np.diff(np.append(begins, len(keepers)))
        of = np.searchsorted(begins, firsts)  # runs of a segment, as every segment begins one
        for pack, own, most in self._packs:
            n = of[own + 1] - of[own]
            segment = np.repeat(np.arange(len(own)), n)
            run = of[own][segment] + np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
            late = keepers[begins[run]] < most[segment]
            segment, run = segment[late], run[late]
            if len(run):
                first = begins[run] - firsts[own[segment]]
                yield pack, segment.astype(np.uint32).tobytes(), first.astype(np.uint32).tobytes(), sizes[run].astype(np.uint32).tobytes(), keepers[begins[run]].tobytes()


def removed(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, their text hashes, and the ranges of bytes that a smaller document has, of a pack's occurrences."""
    of, first, n = (np.frombuffer(row[c], np.uint32).astype(np.int64) for c in ("of", "first", "n"))
    keeper = np.frombuffer(row["keeper"], np.int64)
    segment, place = decoded(row["segment"], np.uint32), decoded(row["doc"], np.uint32)
    start = decoded(row["start"], np.uint32)
    ids, hashes = decoded(row["doc_ids"], np.int64), np.frombuffer(row["text_hashes"], np.int64)
    for at in range(0, len(segment), OCCURRENCES):
        part = slice(at, at + OCCURRENCES)
        low, high = np.searchsorted(of, segment[part]), np.searchsorted(of, segment[part], "right")
        doc = ids[place[part]]
        row_of = np.repeat(np.arange(len(low)), high - low)
        run = low[row_of] + np.arange(len(row_of)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        gone = keeper[run] < doc[row_of]
        row_of, run = row_of[gone], run[gone]
        if not len(run):
            continue
        ends = first[run] + n[run]
        begins = np.flatnonzero(np.concatenate(([True], (row_of[1:] != row_of[:-1]) | (first[run][1:] != ends[:-1]))))
        last = np.append(begins[1:], len(run)) - 1
        own = row_of[begins]
        from_ = start[part][own].astype(np.int64)
        yield doc[own], hashes[place[part][own]], from_ + first[run[begins]], from_ + ends[last] + LENGTH - 1


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """Byte ranges that go: doc_id (NO_ID for null), text_hash, start, end; they may overlap."""
    spark, shards = docs.sparkSession, _shards(docs)
    sent = send_segments(docs, shards, shared_keys(docs, shards))
    waiting = HOLDERS[2:]
    told = ", ".join(["pack bigint, shard int, of binary, first binary, n binary, keeper binary", *(f"{c} binary" for c in waiting)])
    told_kind = arrow_schema(spark, told)
    schema = "doc_id bigint, text_hash bigint, start int, end int"
    kind = arrow_schema(spark, schema)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, Shard()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["keys"] is None:
                    yield pa.RecordBatch.from_pylist([{c: row.get(c) for c in told_kind.names}], schema=told_kind)
                    continue
                if row["shard"] != number and number is not None:
                    yield from tell(number, shard)
                    shard = Shard()
                number = row["shard"]
                shard.add(row)
        if number is not None:
            yield from tell(number, shard)

    def tell(number: int, shard: Shard) -> Iterator[pa.RecordBatch]:
        for pack, *runs in shard.runs():
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((pack, number, *runs, *[None] * len(waiting)), told_kind)], schema=told_kind)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for found in removed(batch.slice(i, 1).to_pylist()[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(found, kind)], schema=kind)

    # Both kinds of rows go through one exchange, so that each task's packs are made once.
    found = materialize(_dealt(spark, sent, "route").mapInArrow(sort, told), "keepers")
    runs = found.filter("of IS NOT NULL").select("pack", "shard", "of", "first", "n", "keeper")
    # A pack and shard stand once on either side, so no key is hot here.
    holders = found.filter("segment IS NOT NULL").select(*HOLDERS)
    return holders.join(runs, ["pack", "shard"]).mapInArrow(expand, schema)


def kept_bytes(raw: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal ranges that go."""
    out, at, spans = [], 0, 0
    for start, end in sorted(ranges):
        if start > at or not spans:
            out.append(raw[at:start])
            spans += 1
        at = max(at, end)
    out.append(raw[at:])
    return b"".join(out), spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Take out of every whole text the bytes covered by a LENGTH-byte string that a smaller doc_id has too.

    Columns: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary: the cut may split a character). A null
    text counts as empty. A null doc_id counts as larger than any other; rows of equal doc_id never cut each other.
    Texts shorter than LENGTH bytes stay whole; other columns are not looked at; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    ranges = materialize(repeated_ranges(docs), "ranges")
    gone = ranges.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    gone = gone.select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "ranges")
    read = texts(docs)
    mine = (F.coalesce(read["doc_id"], F.lit(NO_ID)) == gone["own_id"]) & (F.xxhash64(F.coalesce(read["text"], F.lit(""))) == gone["own_hash"])
    both = read.join(gone, mine, "left").select("doc_id", "text", "ranges.start", "ranges.end")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    kind = arrow_schema(docs.sparkSession, schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for doc_id, text, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode()
                kept, spans = kept_bytes(raw, list(zip(starts or (), ends or ())))
                made.append((doc_id, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], f.type) for i, f in enumerate(kind)], schema=kind)

    return both.mapInArrow(cut, schema)
