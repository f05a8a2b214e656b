"""Packing: ids against the tokenizer, whole sequences, bounded memory, few sequences."""

import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import texts
from texts import docs  # noqa: F401
from marquee.llm import packing

ODD = [
    "<|endoftext|> a<|startoftext|>b", "Ünï ſtraße ĳ ŉx ÀÉ. naïve!? İstanbul ΣΑΣ étude a ̈b", "it's they'll 'S x y\x1cz\x85w　q",
    "\x0bfoo\x0cbar", "ﬁ 漢字 🎉🎉 1234 a1b2", "﻿bom", "x" * 5000 + "é" * 3000, "", ".,;", "***", "ªº µ ß ẞ ŀ", "é Å Å",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_tokenizer())


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]


def check(rows, wanted, capacity):
    """Every piece once, with its ids' checksum, and sequences without gaps or overflow."""
    want = []
    for doc_id, ids in wanted:
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want.append((doc_id, piece, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
    order = lambda r: [(v is not None, v) for v in r]
    assert sorted([tuple(r[:5]) for r in rows], key=order) == sorted(want, key=order)
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(filled)


def test_ids_of_whole_texts(tokenizer):
    known = packing.Stretches(packing.default_tokenizer())
    draw = random.Random(2)
    letters = ["a", "B", "é", "É", "́", " ", "\n", " ", "\x1d", "'", "s", ".", "*", "1", "ß", "Σ", "ς", "<|endoftext|>", "漢"]
    mixed = ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(3000)]
    for text, packed in zip(ODD + mixed, known.packed(ODD + mixed)):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert packed == struct.pack(f"<{len(ids)}I", *ids), text


def test_pieces_and_sequences(spark, docs, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(1000 + i, t) for i, t in enumerate(ODD)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    wanted = [(i, plain_ids(tokenizer, t)) for i, t in rows]
    for capacity in (64, 2048):
        found = packing.pack(table, capacity=capacity, keep_ids=False).collect()
        used = check(found, wanted, capacity)
        total = sum(len(ids) for _, ids in wanted)
        assert used <= total / capacity * 1.1 + 1


def test_sequences_hold_the_ids(spark, docs, tokenizer):
    packed = packing.pack(docs, capacity=256).persist()
    lengths = {r["sequence_id"]: r["n"] for r in packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert {k: len(r["ids"]) for k, r in whole.items()} == lengths
    for r in packed.collect():
        at = r["offset"]
        assert whole[r["sequence_id"]]["ids"][at : at + r["length"]] == r["ids"]
        assert zlib.crc32(struct.pack(f"<{r['length']}I", *r["ids"])) == r["ids_crc32"]
    packed.unpersist()


def test_many_equal_ids_and_few_open(spark, tokenizer):
    """One id holds most rows; with few open sequences the fullest are closed, and nothing is lost."""
    draw = random.Random(5)
    rows = [(7, "word " * draw.randrange(90)) for _ in range(3000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = packing.pack(table, capacity=100, most=4, keep_ids=False).collect()
    used = check(found, [(i, plain_ids(tokenizer, t)) for i, t in rows], 100)
    one_open, free = 0, 0  # documents in their own order, with one open sequence
    for _, text in rows:
        length = len(plain_ids(tokenizer, text))
        one_open, free = (one_open, free - length) if length <= free else (one_open + 1, 100 - length)
    assert used < 0.95 * one_open


def test_best_fit_closes_the_fullest():
    packer = packing.BestFit(10, 2)
    assert packer.place("a", 6) == [] and packer.place("b", 7) == []
    assert packer.place("c", 3) == [[("b", 0), ("c", 7)]]
    assert packer.place("d", 5) == []
    assert packer.place("e", 9) == [[("a", 0)]]
    assert packer.place("f", 10) == [[("f", 0)]]
    assert sorted(packer.rest()) == [[("d", 0)], [("e", 0)]]
    draw, plain, packer = random.Random(3), [], packing.BestFit(50, 10**9)
    for _ in range(2000):
        length = draw.randrange(1, 50)
        best = min((f for f in plain if f >= length), default=None)
        if best is not None:
            plain.remove(best)
        left = (50 if best is None else best) - length
        plain += [left] * bool(left)
        packer.place(length, length)
    assert sorted(s for s, held in packer.by_space.items() for _ in held) == sorted(plain)


def test_empty_clashing_and_missing(spark):
    assert packing.pack(texts.empty(spark), keep_ids=False).collect() == []
    assert packing.sequences(packing.pack(texts.empty(spark))).collect() == []
    clash = texts.clashing(spark, "piece", "offset", "open", "packer", "sequence_id", "length")
    assert packing.pack(clash, keep_ids=False).count() == packing.pack(texts.frame(spark), keep_ids=False).count()
    bare = spark.createDataFrame([(None, None), (None, None), (1, "")], "doc_id bigint, text string")
    found = packing.pack(bare, keep_ids=False).collect()
    assert [(r["piece"], r["start"], r["length"]) for r in found] == [(0, 0, 1)] * 3 and len({r["sequence_id"] for r in found}) == 1
