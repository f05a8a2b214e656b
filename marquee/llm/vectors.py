"""Vectors of whole numbers from a table of embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_vectors(rows: DataFrame, scale: int, most: int, *keep: Column, vector: str = "embedding") -> DataFrame:
    """The kept columns and x, floor(scale * component) of each component as a double, of the rows that take part.

    Rows with no vector, or with a null or non-finite component, take no part; nor do rows whose vector has another
    length than most have (of equally common lengths the longest counts), or with a component beyond `most` units,
    which the exact sums made of them could not hold.
    """
    parts = F.transform(rows[vector], lambda x: x.cast("double"))
    named = rows.select(*keep, parts.alias("_parts")).filter(F.col("_parts").isNotNull())
    finite = lambda x: F.coalesce(F.abs(x) * scale < float(most), F.lit(False)) & ~F.isnan(x)
    good = named.filter(F.forall("_parts", finite)).withColumn("_size", F.size("_parts"))
    usual = good.groupBy("_size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("_size")).first()
    size = usual["_size"] if usual else 0
    whole = F.transform("_parts", lambda x: F.floor(x * scale).cast("bigint"))
    return good.filter(F.col("_size") == size).withColumn("x", whole).drop("_parts", "_size")
