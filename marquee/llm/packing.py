"""Best-fit packing of tokenized documents into sequences of bounded length.

Every task packs the documents it reads: a piece goes into the open sequence whose free space it fills best, and only
OPEN sequences are open at a time, so a task's memory does not depend on its input. Which free spaces occur is a
bitset, so the best one is found by a shift and the lowest bit. A piece that fits nowhere opens a sequence; if too
many are open, the fullest is closed first. A task looks a few pieces for each of them ahead and places those longest first, so that
short ones fill what long ones leave. What is still open when a task ends is taken apart and packed again by a
few tasks of bounded size, longest piece first, so that the number of half-filled sequences does not follow the number
of tasks.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.bpe import byte_letters
from marquee.llm.common import arrow_schema, small_batches, texts
from marquee.session import materialize

# Tokens of a sequence, and the sequences a packer holds open.
CAPACITY, OPEN = 2048, 256
# Sequences that one task packs when what is left over is packed again.
LEFT_OVER = 128
# Pieces for each open sequence that a task looks ahead: they are placed longest first.
AHEAD = 4
# Stretches of text whose ids a worker remembers for sure, the longest one remembered, and how many unknown ones are
# encoded together.
MEMO, LONG_STRETCH, TOGETHER = 500_000, 64, 64
# The id that ends each document.
END = 0

# White space of Python's that the tokenizer may see otherwise; a text with any is split at plain white space only.
_ODD_SPACE = regex.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
# Latin letters whose composed form and lower case need no neighbours, and signs after them: two words of the model.
_PLAIN = regex.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ſ]+)([.,;:!?*]{0,3})")
_PLAIN_SPACE = regex.compile(r"[ \t\r\n]+")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = "sequence_id bigint, offset bigint"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Stretches:
    """Ids of whole texts from those of their stretches between white space.

    The tokenizer drops white space, and no rule of it looks across, so a text's ids are those of its stretches in
    order. Stretches seen before come from memory; plain words go to the tokenizer's model, which merges them, and
    everything else to the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.signs: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def packed(self, whole: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [_PLAIN_SPACE.split(t) if _ODD_SPACE.search(t) else t.split() for t in whole]
        known = self.known
        new = set()
        for found in split:
            new.update(found)
        new.difference_update(known)
        self._learn(new)
        out = [b"".join(map(known.__getitem__, found)) for found in split]
        if len(known) > MEMO:
            self.known, self.older = {}, known
        else:
            for stretch in new:
                if len(stretch) > LONG_STRETCH:
                    del known[stretch]
        return out

    def _learn(self, new: set[str]) -> None:
        known, older, rest = self.known, self.older, []
        for stretch in new:
            ids = older.get(stretch)
            if ids is None:
                plain = _PLAIN.fullmatch(stretch)
                if plain is None:
                    rest.append(stretch)
                    continue
                word, signs = plain.groups()
                ids = self._word(word)
                if signs:
                    ids += self.signs.get(signs) or self.signs.setdefault(signs, self._word(signs))
            known[stretch] = ids
        self._ask(rest)

    def _word(self, word: str) -> bytes:
        """Ids of what the tokenizer hands to its model as one word, once in lower case and with letters for bytes."""
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _ask(self, rest: list[str]) -> None:
        """Encode stretches a few at a time, parted by line ends; offsets tell which stretch an id is of."""
        runs = [rest[i : i + TOGETHER] for i in range(0, len(rest), TOGETHER)]
        for run, found in zip(runs, self.tokenizer.encode_batch(["\n".join(r) for r in runs], add_special_tokens=False)):
            ends = np.cumsum([len(s) + 1 for s in run])
            ids = np.array(found.ids, "<u4")
            first = np.searchsorted(ends, [at for at, _ in found.offsets], side="right")
            cuts = np.searchsorted(first, np.arange(len(run) + 1))
            self.known.update((s, ids[a:b].tobytes()) for s, a, b in zip(run, cuts, cuts[1:]))


@lru_cache(maxsize=1)
def stretches(path: str) -> Stretches:
    """A worker process serves many tasks; they share what it remembers."""
    return Stretches(path)


class BestFit:
    """Sequences under construction; `place` and `rest` return those that are finished, as lists of items."""

    def __init__(self, capacity: int, most: int) -> None:
        self.capacity, self.most = capacity, most
        self.spaces = 0  # bit f is set while an open sequence has f tokens free
        self.by_space: dict[int, list[list]] = {}
        self.open = 0

    def _take(self, space: int) -> list:
        waiting = self.by_space[space]
        sequence = waiting.pop()
        if not waiting:
            self.spaces &= ~(1 << space)
        self.open -= 1
        return sequence

    def place(self, item, length: int) -> list[list]:
        """Put an item of 1 to `capacity` tokens where it leaves the least space."""
        finished = []
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(space)
        else:
            space, sequence = self.capacity, []
            if length < self.capacity and self.open == self.most:
                fullest = (self.spaces & -self.spaces).bit_length() - 1
                finished.append(self._take(fullest))
        sequence.append((item, self.capacity - space))
        space -= length
        if not space:
            finished.append(sequence)
            return finished
        self.by_space.setdefault(space, []).append(sequence)
        self.spaces |= 1 << space
        self.open += 1
        return finished

    def rest(self) -> list[list]:
        return [sequence for space in sorted(self.by_space) for sequence in self.by_space[space]]


def _cut(doc_id: int | None, packed: bytes, capacity: int, keep_ids: bool) -> Iterator[tuple]:
    """The pieces of a document: id, number, place, length, checksum, ids."""
    packed += struct.pack("<I", END)
    for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
        own = packed[at : at + 4 * capacity]
        ids = (memoryview(own).cast("I").tolist(),) if keep_ids else ()
        yield doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own), *ids


class _Rows:
    """Collects rows and hands them out as Arrow batches."""

    def __init__(self, schema: pa.Schema, most: int = 4096) -> None:
        self.schema, self.most, self.rows = schema, most, []

    def add(self, sequence: list, sequence_id: int, *more) -> None:
        self.rows += [(*item, sequence_id, offset, *more) for item, offset in sequence]

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (last or len(self.rows) >= self.most):
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
            self.rows = []


def _pack_task(kind: pa.Schema, path: str, capacity: int, most: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packer, out = stretches(path), BestFit(capacity, most), _Rows(kind)
        number, ahead = TaskContext.get().partitionId() << 40, []

        def place() -> int:
            done = number
            for item in sorted(ahead, key=lambda item: -item[3]):
                for sequence in packer.place(item, item[3]):
                    out.add(sequence, done, False)
                    done += 1
            ahead.clear()
            return done

        for batch in batches:
            ids = batch.column(0).to_pylist()
            whole = known.packed([t or "" for t in batch.column(1).to_pylist()])
            for doc_id, packed in zip(ids, whole):
                for item in _cut(doc_id, packed, capacity, keep_ids):
                    ahead.append(item)
                    if len(ahead) == AHEAD * most:
                        number = place()
                        yield from out.batches()
        number = place()
        for sequence in packer.rest():
            out.add(sequence, number, True)
            number += 1
        yield from out.batches(last=True)

    return run


def _repack_group(kind: pa.Schema, capacity: int) -> Callable:
    """Packs the pieces of one group, longest first; their number is bounded by that of the sequences they filled."""

    def run(table: pa.Table) -> pa.Table:
        packer, out = BestFit(capacity, table.num_rows), _Rows(kind)
        table = table.sort_by([("length", "descending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        number = (1 << 62) + (table.column("packer")[0].as_py() << 32)
        pieces = list(zip(*[table.column(f.name).to_pylist() for f in kind if f.name not in ("sequence_id", "offset")]))
        done = [sequence for item in pieces for sequence in packer.place(item, item[3])]
        for sequence in done + packer.rest():
            out.add(sequence, number)
            number += 1
        return pa.Table.from_batches(list(out.batches(last=True)), schema=kind)

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, most: int = OPEN, keep_ids: bool = True) -> DataFrame:
    """Tokenize every whole text, end it with END, and pack the documents into sequences of at most `capacity` tokens.

    A row for each piece: doc_id, piece (from 0), start (its document's ids before it), length, ids_crc32 (of the ids
    as little-endian unsigned 32-bit integers), ids (if kept), sequence_id, offset (its place there; pieces of a
    sequence stand without gaps). Only documents longer than `capacity` are cut. A null text counts as empty, and an
    empty text is one piece of END alone. Rows with a null or repeated doc_id are packed like any other, other columns
    are not looked at, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = path or default_tokenizer()
    pieces = f"{PIECES}, ids array<int>" if keep_ids else PIECES
    first, second = f"{pieces}, {PLACED}, open boolean", f"{pieces}, {PLACED}"
    run = _pack_task(arrow_schema(spark, first), path, capacity, most, keep_ids)
    placed = materialize(texts(docs).mapInArrow(run, first), "packed")
    left = placed.filter("open").drop("open")
    sequences = left.filter("offset = 0").count()
    if not sequences:
        return placed.drop("open")
    # Dealt by place, as one document id may hold any number of pieces.
    groups = left.withColumn("packer", F.pmod(F.xxhash64("sequence_id", "offset"), F.lit(-(-sequences // LEFT_OVER))))
    again = groups.groupBy("packer").applyInArrow(_repack_group(arrow_schema(spark, second), capacity), second)
    return placed.filter("not open").drop("open").unionByName(again)


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences of a packing that kept its ids: sequence_id, ids, and of each piece in order its
    document (doc_ids) and its place (offsets).

    A sequence is bounded by its capacity, so it is gathered in one row.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", F.col("doc_id").alias("doc"))))
    gathered = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return gathered.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc").alias("doc_ids"), F.col("parts.offset").alias("offsets"))
