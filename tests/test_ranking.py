"""The stepped rank and the chunked moving window against plain windows, on skewed input."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from marquee.operators import ranking
from marquee.operators.keys import deduplicate, top_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a third of that on one value, nulls in key and value."""
    i = F.col("id")
    group = F.when(i % 3 == 0, "hot").when(i % 50 != 1, F.concat(F.lit("g"), (i % 7).cast("string")))
    value = F.when(i % 9 == 0, 5.0).when(i % 41 != 2, (F.hash("id") % 200).cast("double"))
    df = spark.range(6000).select("id", group.alias("g"), value.alias("v"))
    return spark.createDataFrame(df.collect(), df.schema).cache()


@pytest.mark.parametrize("kind", ["dense_rank", "rank"])
@pytest.mark.parametrize("way", ["desc", "asc"])
def test_ranks(spark, skewed, kind, way):
    got = ranking.group_rank(skewed, ["g"], [("v", way)], kind, "r")
    order = F.col("v").desc() if way == "desc" else F.col("v").asc()
    plain = skewed.withColumn("r", getattr(F, kind)().over(Window.partitionBy("g").orderBy(order)).cast("bigint"))
    assert rows(got, "id", "r") == rows(plain, "id", "r")


def test_top_ranks(spark, skewed):
    got = ranking.group_rank(skewed, ["g"], [("v", "desc")], "dense_rank", "r", top=3)
    plain = skewed.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())).cast("bigint"))
    assert rows(got, "id", "r") == rows(plain.filter("r <= 3"), "id", "r")


def test_row_numbers(spark, skewed):
    got = ranking.group_rank(skewed, ["g"], [("v", "desc"), ("id", "asc")], "row_number", "r")
    window = Window.partitionBy("g").orderBy(F.col("v").desc(), "id")
    assert rows(got, "id", "r") == rows(skewed.withColumn("r", F.row_number().over(window).cast("bigint")), "id", "r")


def test_steps_keep_the_order(spark):
    numbers = [float("-inf"), -1e30, -3.5, -3.0, -1e-9, 0.0, 1e-310, 1e-9, 1.0, 1.0001, 2.0, 3.999999, 4.0, 1e15, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(numbers)], "i int, v double")
    steps = [r["s"] for r in df.withColumn("s", ranking.coarse(df, "v")).orderBy("i").collect()]
    assert steps == sorted(steps) and len(set(steps)) >= 14


def test_building_a_rank_starts_no_job(spark, skewed):
    spark.sparkContext.setJobGroup("building", "none")
    ranking.group_rank(skewed, ["g"], [("v", "desc")], "rank", "r")
    ranking.moving_rows(skewed, ["g"], [("id", "asc")], 9, {"s": F.sum("id")})
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []


def test_a_window_holds_no_hot_group_or_tie(spark, skewed):
    plan = ranking.group_rank(skewed, ["g"], [("v", "desc")], "rank", "r")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert len(windows) == 2 and all("_step" in line or "_at" in line for line in windows)


@pytest.mark.parametrize("kind", ["dense_rank", "rank"])
def test_one_tie(spark, kind):
    df = spark.range(500).withColumns({"g": F.lit(None).cast("string"), "v": (F.col("id") == 7).cast("int")})
    got = ranking.group_rank(df, ["g"], [("v", "desc")], kind, "r").groupBy("v", "r").count()
    assert rows(got, "v", "r", "count") == [(0, 2, 499), (1, 1, 1)]


@pytest.mark.parametrize("chunk", [10, 37, 100000])
def test_chunked_moving_window(spark, skewed, chunk):
    order = [("v", "asc"), ("id", "asc")]
    got = ranking.moving_rows(skewed, ["g"], order, 9, {"s": F.sum("id"), "n": F.count("v")}, chunk_rows=chunk)
    frame = Window.partitionBy("g").orderBy("v", "id").rowsBetween(-9, 0)
    plain = skewed.withColumns({"s": F.sum("id").over(frame), "n": F.count("v").over(frame)})
    assert rows(got, "id", "s", "n") == rows(plain, "id", "s", "n")


def test_chunk_must_exceed_frame(spark, skewed):
    with pytest.raises(ValueError):
        ranking.moving_rows(skewed, ["g"], [("id", "asc")], 9, {"s": F.sum("id")}, chunk_rows=9)


def test_dedup_prunes_before_the_shuffle(spark, skewed):
    last = deduplicate(skewed, ["g"], [F.col("id")])
    assert "WindowGroupLimit" in last._jdf.queryExecution().executedPlan().toString()
    assert rows(last, "g", "id") == rows(skewed.groupBy("g").agg(F.max("id").alias("id")), "g", "id")
    first = deduplicate(skewed, ["g"], [F.col("id")], keep="first")
    assert rows(first, "g", "id") == rows(skewed.groupBy("g").agg(F.min("id").alias("id")), "g", "id")


def test_dedup_of_full_ties_is_stable(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "k int, v string").withColumn("t", F.lit(0))
    kept = {deduplicate(df.repartition(n), ["k"], [F.col("t")]).first()["v"] for n in (1, 2, 3)}
    assert len(kept) == 1


def test_top_rows(spark, skewed):
    got = top_rows(skewed, ["g"], [F.col("id")], 2).groupBy("g").count()
    assert {r["count"] for r in got.collect()} == {2}
