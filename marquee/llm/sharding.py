"""Balanced shards by label propagation, in DataFrame operations only.

Documents of equal text are linked. Links are kept as a star through the text's
digest, never as pairs. A cell is all documents of one text that began in one
shard, so a text has at most as many cells as there are shards, however many
copies it has. In each round every cell looks where most of its neighbours are
and moves there, as far as the shard's quota has room; a text larger than a
quota gathers in as many shards as it fills. Documents without links then fill
each shard to its exact size, as moving them cuts nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialize

# Shards, the most rounds, and rounds without a move after which it ends.
SHARDS, ROUNDS, IDLE = 24, 12, 2
# Rows that one numbering task handles, about.
SLICE_ROWS = 500_000
# Moves are let in by size and then by one of so many hash bins, whose sums alone are compared with the room.
MOVE_BINS = 64


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _array(values: list[int]) -> Column:
    return F.array(*[_long(v) for v in values])


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Deal rows into shards whose row counts differ by one at most, keeping equal texts together.

    Columns: doc_id, size (UTF-8 bytes and 8), text_crc32, law ("rows"), shard, slot (from 0 without a gap in each
    shard), grown_shard (null under this law), linked (whether another row has the text). A null text has no bytes
    and is linked with empty ones; rows with null or repeated ids each get their own slot; other columns are not
    looked at; an empty table gives an empty result.
    """
    raw = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    read = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        (F.octet_length(raw) + _long(8)).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.md5(raw)).alias("digest"),
    )
    home = F.pmod(F.xxhash64("digest", "doc_id"), F.lit(shards)).cast("int")
    rows = materialize(read.withColumn("home", home), "shard-rows")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    cells = rows.groupBy("digest", "home").agg(F.count("*").alias("n"))
    # At most one row for each shard and text stands in this window.
    of_text = Window.partitionBy("digest")
    linked = cells.withColumn("copies", F.sum("n").over(of_text)).filter("copies > 1").withColumn("shard", F.col("home"))
    state = materialize(linked, "cells")
    idle = 0
    for turn in range(ROUNDS):
        moved = materialize(_moved(state, quota, turn), "cells")
        # Another turn's hashes choose other shards for texts of equal standing.
        idle = idle + 1 if moved.filter("moves").isEmpty() else 0
        if idle == IDLE:
            break
        state = moved.drop("moves")
    placed = rows.join(state.select("digest", "home", "n", "shard"), ["digest", "home"], "left").select(
        "doc_id", "size", "text_crc32", "digest", F.coalesce("n", _long(1)).alias("n"),
        F.col("shard").isNotNull().alias("linked"), F.coalesce("shard", "home").alias("shard"),
    )
    return _filled(placed, quota, total).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "linked",
    )


def _moved(state: DataFrame, quota: list[int], turn: int) -> DataFrame:
    """One round: the cells with their new shards, and whether each one moves."""
    shards = len(quota)
    load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    free = _array([max(0, q - load.get(s, 0)) for s, q in enumerate(quota)])
    least = max(1, min(quota))
    # How a text is spread, and which of its shards keep it: as many as it fills, those with most of it first.
    spread = state.groupBy("digest", "copies", "shard").agg(F.sum("n").alias("here"))
    fits = F.get(free, F.col("shard")) >= F.least("copies", _long(least)) - F.col("here")
    order = Window.partitionBy("digest").orderBy(fits.desc(), F.desc("here"), F.xxhash64("digest", "shard", F.lit(turn)))
    ranked = spread.withColumn("place", F.row_number().over(order) - 1)
    keeps = F.ceil(F.col("copies") / F.lit(least)).cast("int")
    whole = Window.partitionBy("digest").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    targets = ranked.withColumn("target", F.get(F.collect_list("shard").over(whole), F.col("place") % keeps))
    wished = state.join(targets.select("digest", "shard", "target"), ["digest", "shard"])
    # Large cells first, then by hash; whole bins go in while their running sum fits the room. What wishes to leave
    # a shard makes room in it: full shards trade documents, and what then is too much goes back in the next round.
    rank = F.struct((-F.floor(F.log2("n"))).alias("class"), F.pmod(F.xxhash64("digest", "home", F.lit(turn)), F.lit(MOVE_BINS)).alias("bin"))
    wished = wished.withColumn("rank", rank)
    bins = wished.filter("target <> shard").groupBy("shard", "target", "rank").agg(F.sum("n").alias("n"))
    bins = materialize(bins, "moves")
    leaving = {r["shard"]: r["n"] for r in bins.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    room = _array([max(0, q - load.get(s, 0) + leaving.get(s, 0)) for s, q in enumerate(quota)])
    before = Window.partitionBy("target").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    # A bin larger than the room keeps none of the smaller ones out.
    sums = bins.groupBy("target", "rank").agg(F.sum("n").alias("n")).filter(F.col("n") <= F.get(room, F.col("target")))
    let_in = sums.withColumn("sum", F.sum("n").over(before)).filter(F.col("sum") <= F.get(room, F.col("target")))
    found = wished.join(let_in.select("target", "rank", F.lit(True).alias("free")), ["target", "rank"], "left")
    moves = (F.col("target") != F.col("shard")) & F.coalesce("free", F.lit(False))
    return found.select("digest", "home", "n", "copies", F.when(moves, F.col("target")).otherwise(F.col("shard")).alias("shard"), moves.alias("moves"))


def _filled(placed: DataFrame, quota: list[int], total: int) -> DataFrame:
    """Number the rows of each shard, linked ones first and text by text; numbers beyond the quota go on to shards
    that lack rows. Shards are numbered in slices, and a cell that is larger than a slice is cut by document."""
    slices = max(8, -(-total // SLICE_ROWS))
    cuts = F.ceil(F.col("n") / F.lit(SLICE_ROWS))
    part = F.struct(
        (~F.col("linked")).alias("last"),
        F.pmod(F.xxhash64("digest"), F.lit(slices)).alias("slice"),
        F.when(cuts > 1, F.struct("digest", F.pmod(F.xxhash64("doc_id"), cuts).alias("cut"))).alias("cell"),
    )
    rows = placed.withColumn("part", part)
    counts = materialize(rows.groupBy("shard", "part").agg(F.count("*").alias("n")), "slices")
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("shard").alias("of"), F.col("part").alias("slice"), F.coalesce(F.sum("n").over(earlier), _long(0)).alias("offset"))
    held = {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    held = [held.get(s, 0) for s in range(len(quota))]
    over, lacking = [0], [0]
    for has, wants in zip(held, quota):
        over.append(over[-1] + max(0, has - wants))
        lacking.append(lacking[-1] + max(0, wants - has))
    inside = Window.partitionBy("shard", "part").orderBy("digest", "doc_id")
    known = (rows["shard"] == offsets["of"]) & rows["part"].eqNullSafe(offsets["slice"])
    numbered = rows.join(offsets, known).withColumn("place", F.col("offset") + F.row_number().over(inside) - 1)
    own = F.get(_array(quota), F.col("shard"))
    beyond = F.get(_array(over), F.col("shard")) + F.col("place") - own
    # The shard whose gap holds the number: as many gaps end at or before it.
    target = sum(((beyond >= _long(end)).cast("int") for end in lacking[1:-1]), F.lit(0))
    slot = F.get(_array(held), target) + beyond - F.get(_array(lacking), target)
    stays = F.col("place") < own
    return numbered.select(
        "doc_id", "size", "text_crc32", "linked",
        F.when(stays, F.col("shard")).otherwise(target).cast("int").alias("shard"),
        F.when(stays, F.col("place")).otherwise(slot).alias("slot"),
    )
