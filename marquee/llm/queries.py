"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, decontaminate, licences, lines, negatives, packing, pii, quality, sharding, simhash, substrings, toxicity, whitening
from marquee.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Where a result cannot be told in SQL, tests hold it against brute force, round trips or held-out rows.
SQL: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@_query
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(read_table(spark, folder, "documents"), keep_ids=False)


@_query
def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan_licences(read_table(spark, folder, "documents"))


@_query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge_quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@_query
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, folder, "documents")).drop("found")


@_query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@_query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


@_query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@_query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, folder, "documents"))


@_query
def op9_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_report(read_table(spark, folder, "documents"))


@_query
def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(read_table(spark, folder, "documents")).drop("kept")


@_query
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"), keep_ids=False)


@_query
def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


SQL["op11_negatives"] = """
with whole as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda c: floor(256 * cast(c as double))) as x
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
scored as (
  select a.row as anchor, a.vec_id as anchor_id, b.vec_id as other_id, b.row as other, a.label = b.label as same,
         cast(list_inner_product(a.x, b.x) as bigint) as score
  from whole a join whole b on a.row <> b.row where a.vec_id % 50 = 0),
positives as (
  select anchor, anchor_id, other_id as positive_id, other as positive, score as positive_score
  from scored where same
  qualify row_number() over (partition by anchor order by score desc, other_id, other) <= 5)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor, p.positive order by s.score desc, s.other_id) as integer) as rank,
       s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor = p.anchor
where not s.same and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
qualify rank <= 3"""


@_query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_table(spark, folder, "embeddings"))
