"""SimHash fingerprints and near-duplicate documents by covering locality-sensitive hashing.

Every bit position carries a code of RADIUS + 1 bits. For each non-zero vector
of that length there is a mask of the positions whose code has odd parity with
it. Up to RADIUS differing positions always leave a vector orthogonal to all
their codes, and under its mask the two fingerprints are equal: each pair within
the radius collides in some table, with certainty. A bucket that is still large
is masked again on the bits its mask left out, which keeps the certainty and
bounds every bucket, as only few free bits remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marquee.llm.common import arrow_schema, per_text, text_hash
from marquee.llm.graph import components
from marquee.session import materialize

WORDS, RADIUS, SEED = 3, 3, 42
# Fingerprints of a bucket that are compared with each other at once; larger buckets are masked a second time.
BUCKET = 4096
# Hashes whose bits are counted at once.
CHUNK = 1 << 16

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def hashes(text: str | None, size: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle of `size` words of a whole text, A-Z in lower case, repeats included."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= size:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())), np.uint64, n)


def fingerprint(found: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; zero without hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(found), CHUNK):
        part = found[at : at + CHUNK].astype(">u8").view(np.uint8)
        counts += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(found)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """doc_id, fingerprint in hex digits, the same bits as a signed long, and a hash of the text."""

    def rows(ids: list, whole: list) -> dict:
        found = [fingerprint(hashes(text, size)) for text in whole]
        return {
            "doc_id": ids,
            "fingerprint": [f"{x:016x}" for x in found],
            "bits": [_signed(x) for x in found],
            "text_hash": [_signed(xxh64_intdigest((text or "").encode(), SEED)) for text in whole],
        }

    return per_text(docs, "doc_id bigint, fingerprint string, bits bigint, text_hash bigint", rows)


def covering_masks(radius: int, free: int = (1 << 64) - 1) -> list[int]:
    """Masks within the `free` bits such that any `radius` of those bits are all outside one of them."""
    size = (1 << (radius + 1)) - 1
    places = [i for i in range(64) if free >> i & 1]
    return [sum(1 << p for j, p in enumerate(places) if ((j % size + 1) & v).bit_count() % 2) for v in range(1, size + 1)]


def _signed(bits: int) -> int:
    return bits - (bits >> 63 << 64)


def _tables(rows: DataFrame, masks: list[int]) -> DataFrame:
    """A row for each fingerprint and mask, with the bits under the mask."""
    keys = [F.struct(F.lit(i).alias("part"), F.col("bits").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]
    return rows.select("bits", F.explode(F.array(*keys)).alias("k")).select("bits", "k.part", "k.key")


def linked(found: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Every fingerprint but the first of each component within a bucket, with that first one.

    A reached fingerprint is compared with those not reached yet, so a dense group costs little more than its size."""
    rest = np.sort(found).view(np.uint64)  # bits of signed numbers are not counted as such
    while len(rest) > 1:
        first, rest = rest[:1], rest[1:]
        queue, root = [first[0]], int(first.view(np.int64)[0])
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= radius
            if near.any():
                reached, rest = rest[near], rest[~near]
                queue.extend(reached)
                for x in reached.view(np.int64).tolist():
                    yield x, root


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect just what pairs within the radius connect; `distinct` has each fingerprint once."""
    spark, masks = distinct.sparkSession, covering_masks(radius)
    tables = _tables(distinct, masks)
    sizes = tables.groupBy("part", "key").agg(F.count("*").alias("n"), F.min("bits").alias("a"), F.max("bits").alias("b"))
    shared = materialize(sizes.filter("n > 1"), "buckets")
    pairs = shared.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
    members = tables.join(shared.filter("n > 2").select("part", "key", "n"), ["part", "key"])
    large = members.filter(F.col("n") > bucket)
    # The second masks are taken on the bits that the first mask of the table left free.
    nested = [[m | inner for inner in covering_masks(radius, ~m & ((1 << 64) - 1))] for m in masks]
    second = F.array(*[F.array(*[F.lit(_signed(x)) for x in row]) for row in nested])
    deeper = large.select("bits", "part", F.posexplode(F.element_at(second, F.col("part") + 1)).alias("inner", "mask"))
    groups = members.filter(F.col("n") <= bucket).groupBy("part", "key").agg(F.collect_list("bits").alias("found"))
    deep = deeper.groupBy("part", "inner", F.col("bits").bitwiseAND(F.col("mask")).alias("key")).agg(F.collect_list("bits").alias("found"))
    kind = arrow_schema(spark, "a bigint, b bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [link for x in batch.column(0).to_pylist() if len(x) > 1 for link in linked(np.array(x, dtype=np.int64), radius)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], schema=kind)

    inside = groups.select("found").unionByName(deep.select("found")).mapInArrow(run, "a bigint, b bigint")
    return pairs.unionByName(inside)


def near_duplicates(docs: DataFrame, size: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Groups of documents whose fingerprints are linked by at most `radius` differing bits, a row for each row.

    Columns: doc_id, fingerprint, component_id: the smallest doc_id that can be reached, null only if all of the
    group's ids are null. A null or empty text has fingerprint zero and is linked like any other. Rows with one
    fingerprint, copies and repeated rows among them, are one node of the search, however many there are.
    """
    prints = materialize(fingerprints(docs, size), "fingerprints")
    nodes = prints.groupBy("bits").agg(F.min("doc_id").alias("first"))
    placed = _placed(nodes, prints, radius)
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    known = placed.join(least, "root").select("bits", "component_id")
    return prints.join(known, "bits").select("doc_id", "fingerprint", "component_id")


def _placed(nodes: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """`nodes`, a row for each fingerprint, with the root of its group."""
    roots = components(links(prints.select("bits").distinct(), radius))
    return nodes.join(roots, nodes["bits"] == roots["node"], "left").select("bits", "first", F.coalesce("root", "bits").alias("root"))


def keep_first(docs: DataFrame, size: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each group of `near_duplicates`, with all columns: that of the smallest doc_id, null ids last.

    Rows are told apart by doc_id and text; of rows equal in both, one stays if they do.
    """
    prints = materialize(fingerprints(docs, size), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    nodes = prints.groupBy("bits").agg(F.min(order).alias("first"))
    stays = _placed(nodes, prints, radius).groupBy("root").agg(F.min("first").alias("first"))
    keys = stays.select(F.col("first.doc_id").alias("own_id"), F.col("first.text_hash").alias("own_hash"))
    names = [f"_key{i}_{'_'.join(docs.columns)}" for i in (0, 1)]  # like no column there is
    marked = docs.withColumns({names[0]: docs["doc_id"].cast("bigint"), names[1]: text_hash(docs["text"])})
    mine = marked[names[0]].eqNullSafe(keys["own_id"]) & (marked[names[1]] == keys["own_hash"])
    return marked.join(keys, mine, "left_semi").dropDuplicates(names).select(*docs.columns)
