"""Gates, merges, layers, warehouse, export and streaming."""

import datetime as dt
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import day, rows
from marquee.contracts import EXPORTS, MOVIE
from marquee.operators import merge, quality, serving
from marquee.operators.quality import QualityError
from marquee.session import scratch_dir
from marquee.sources import commits, export, jdbc, landing, layers
from marquee.sources.warehouse import Warehouse
from marquee.streaming import bronze

# --- gates ---


def test_required_columns(spark):
    with pytest.raises(quality.QualityError, match="genre_ids"):
        quality.require_columns(spark.range(1), MOVIE)


def test_required_values(spark):
    schema = "id bigint, name string, popularity string, known_for_department string"
    whole = spark.createDataFrame([(1, None, "1", "x"), (2, "a", "1", "x")], schema)
    split = spark.createDataFrame([(1, None, "1", "x"), (2, "a", None, "x")], schema)
    quality.require_values(whole, "person")
    quality.require_values(split, "person")
    with pytest.raises(quality.QualityError, match="known_for_department"):
        quality.require_values(whole.withColumn("known_for_department", F.lit(None).cast("string")), "person")


@pytest.mark.parametrize(
    "items, valid", [([], False), ([(1, "s", "t"), (2, "s", "t")], True), ([(1, "s", None)], False), ([(None, "s", "t")], False)]
)
def test_batch_validation(spark, items, valid):
    df = spark.createDataFrame(items, "id bigint, _source string, _extracted_at string")
    assert quality.batch_is_valid(df) is valid


def test_batch_without_a_required_column(spark):
    assert quality.batch_is_valid(spark.createDataFrame([(1, "s")], "id bigint, _source string")) is False


def test_violations_and_flags(spark):
    df = spark.createDataFrame(
        [(1, 11.0, 1.0), (None, -1.0, -2.0), (3, None, 0.0), (4, 10.0, 1.0)], "id bigint, vote_average double, popularity double"
    )
    counts = quality.violations(df).first().asDict()
    assert counts == {"records": 4, "null_ids": 1, "scores_out_of_range": 2, "negative_popularity": 1}
    with pytest.raises(quality.QualityError, match="1 of 4"):
        quality.require_ids(counts, "feed")
    assert [r[0] for r in quality.flag_scores(df).select("_dq_vote_avg_valid").collect()] == [False, False, None, True]


def test_rules_ignore_absent_columns(spark):
    df = spark.createDataFrame([(1.0,), (9.0,)], "a double")
    assert quality.passes(df, {"a": {"min": 0, "max": 10}, "b": {"min": 5}})
    assert not quality.passes(df, {"a": {"max": 5}})
    assert quality.passes(df, {"b": {"max": 0}})


def test_load_and_export_gates(spark):
    fact = spark.createDataFrame([(day("2026-01-01"),)], "date date")
    counts = quality.load_counts(fact, spark.range(2), spark.range(3), F.lit("2026-01-02").cast("date")).first().asDict()
    assert counts == {"facts": 0, "movies": 2, "genres": 3}
    with pytest.raises(quality.QualityError):
        quality.require_load(counts)
    assert [quality.export_status(5, n) for n in (4, 5, 6)] == ["FAILED", "PASSED", "PASSED"]
    good, bad = {"status": "SUCCESS"}, {"status": "FAILED"}
    assert quality.overall_status([good], []) == "success"
    assert quality.overall_status([good, bad], []) == "partial_failure"
    assert quality.overall_status([good], [{"status": "FAILED"}]) == "partial_failure"


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "c int, p int")
    assert rows(quality.orphans(child, "p", spark.createDataFrame([(1,)], "pid int"), "pid"), "c") == [(2,)]


# --- merges ---


def table(spark, *items):
    return spark.createDataFrame(list(items), "k int, a string, b string")


def test_upsert_twice_is_the_same(spark):
    target, staged = table(spark, (1, "a", "x"), (2, "b", "y")), table(spark, (2, "B", "Y"), (3, "C", "Z"))
    once = merge.upsert(target, staged, ["k"])
    assert rows(once) == [(1, "a", "x"), (2, "B", "Y"), (3, "C", "Z")]
    assert rows(merge.upsert(once, staged, ["k"])) == rows(once)


def test_upsert_keeps_named_columns_only_on_update(spark):
    target, staged = table(spark, (1, "a", None), (2, "b", "y")), table(spark, (1, None, "n"), (3, "C", "Z"))
    merged = merge.upsert(target, staged, ["k"], keep=["b"])
    assert rows(merged) == [(1, None, None), (2, "b", "y"), (3, "C", "Z")]


def test_replace_and_insert_absent(spark):
    target, batch = table(spark, (1, "a", "x"), (2, "b", "y")), table(spark, (2, "B", "Y"), (2, "B2", "Y2"), (3, "d", "w"))
    assert rows(merge.replace_by_key(target, batch, ["k"]), "k", "a") == [(1, "a"), (2, "B"), (2, "B2"), (3, "d")]
    sent = table(spark, (2, "B", "Y"), (3, "second", "2"), (3, "first", "1"))
    got = merge.insert_absent(target, sent, ["k"], [F.col("b")])
    assert rows(got, "k", "a") == [(1, "a"), (2, "b"), (3, "first")]


def test_delete_cascade_and_set_null(spark):
    child, gone = table(spark, (1, "p", "x"), (2, "q", "y"), (3, None, "z")), spark.createDataFrame([("p",)], "id string")
    assert rows(merge.delete_cascade(child, "a", gone, "id"), "k") == [(2,), (3,)]
    assert rows(merge.set_null(child, "a", gone, "id"), "k", "a") == [(1, None), (2, "q"), (3, None)]


FACT = "movie_id bigint, media_type string, date date, position int, popularity double"


def facts(spark, *items):
    return spark.createDataFrame([(m, "movie", day(d), p, pop) for m, d, p, pop in items], FACT)


def test_warehouse_rewrites_only_touched_days(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    key = ["movie_id", "date", "media_type"]

    def upsert(old, new):
        return merge.upsert(old, new, key)

    assert warehouse.read("fact_daily_trends").count() == 0
    warehouse.merge("fact_daily_trends", facts(spark, (1, "2026-01-01", 1, 5.0), (1, "2026-01-02", 1, 5.0)), upsert)
    first_day = lambda: set((tmp_path / "fact_daily_trends").rglob("date=2026-01-01/*.parquet"))
    untouched = first_day()
    assert untouched
    for _ in range(2):
        warehouse.merge("fact_daily_trends", facts(spark, (1, "2026-01-02", 2, 4.0), (2, "2026-01-02", 1, 9.0)), upsert)
    got = rows(warehouse.read("fact_daily_trends"), "movie_id", "date", "position")
    assert got == [(1, day("2026-01-01"), 1), (1, day("2026-01-02"), 2), (2, day("2026-01-02"), 1)]
    assert first_day() == untouched


def test_warehouse_refuses_repeated_keys(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(quality.QualityError, match="repeats"):
        warehouse.merge("fact_daily_trends", facts(spark, (1, "2026-01-01", 1, 5.0), (1, "2026-01-01", 2, 5.0)), lambda o, n: n)


def test_warehouse_versions(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))

    def upsert(old, new):
        return merge.upsert(old, new, ["genre_id"])

    genres = spark.createDataFrame([(28, "Action"), (18, "Drama")], "genre_id int, name string")
    warehouse.merge("dim_genres", genres, upsert)
    (tmp_path / "dim_genres" / "commit=unpublished" / "bucket=0").mkdir(parents=True)  # a write that never finished
    assert warehouse.read("dim_genres").count() == 2
    warehouse.merge("dim_genres", spark.createDataFrame([(18, "Dramas"), (12, "Adventure")], "genre_id int, name string"), upsert)
    assert rows(warehouse.read("dim_genres")) == [(12, "Adventure"), (18, "Dramas"), (28, "Action")]


# --- layers, landing and export ---


def test_landed_records(spark, tmp_path):
    folder = tmp_path / "raw" / "trending_movies" / "date=2026-06-29"
    folder.mkdir(parents=True)
    good = {"id": 1, "title": "A", "popularity": "oops", "genre_ids": [28], "release_date": ""}
    (folder / "part.json").write_text(json.dumps(good) + "\n" + "{broken\n")
    raw = landing.with_lineage(landing.read_raw(spark, str(tmp_path), "trending_movies", "2026-06-29"),
                               "trending_movies", "2026-06-29", "b", "feed")
    got = rows(raw, "id", "title", "_corrupt_record", "_batch_id", "_extraction_date")
    assert got == [(None, None, "{broken", "b", day("2026-06-29")), (1, "A", None, "b", day("2026-06-29"))]
    assert raw.first()["_file_path"].endswith("part.json")


def test_landed_arrays(spark, tmp_path):
    folder = tmp_path / "raw" / "trending_people" / "date=2026-06-29"
    folder.mkdir(parents=True)
    (folder / "data.json").write_text(json.dumps([{"id": 1, "name": "A"}, {"id": 2, "name": "B"}], indent=2))
    assert landing.read_raw(spark, str(tmp_path), "trending_people", "2026-06-29", json_array=True).count() == 2


def test_landing_replaces_only_its_days(spark, tmp_path):
    df = spark.createDataFrame([(1, day("2026-01-01")), (2, day("2026-01-02"))], "id bigint, date date")
    landing.write_landing(df, str(tmp_path), "trending_people")
    landing.write_landing(spark.createDataFrame([(3, day("2026-01-02"))], "id bigint, date date"), str(tmp_path), "trending_people")
    got = spark.read.json(str(tmp_path / "raw" / "trending_people"))
    assert rows(got, "id") == [(1,), (3,)]


def test_stream_picks_up_each_file_once(spark, tmp_path):
    base = str(tmp_path)
    for number, text in ((1, "2026-01-01"), (2, "2026-02-01")):
        df = spark.createDataFrame([(number, day(text))], "id bigint, date date")
        landing.write_landing(df, base, "trending_people")
        for _ in range(2):
            bronze.ingest_available(spark, base, "trending_people", "feed", f"{base}/bronze", f"{base}/progress")
    got = layers.read_layer(spark, f"{base}/bronze")
    assert rows(got, "id", "year", "month") == [(1, 2026, 1), (2, 2026, 2)]


def test_export_projection_flattens_arrays(spark):
    df = spark.createDataFrame([(1, ["A", "B"], "x")], "id bigint, title array<string>, extra string")
    assert rows(export.export_projection(df, "gold_daily_trends")) == [(1, "A, B")]
    assert all(set(e.key) <= set(e.columns) for e in EXPORTS.values())


def test_write_counts_rows(spark, tmp_path):
    assert commits.write_counted(spark.range(7), str(tmp_path / "t"), "overwrite", []) == 7


def test_jdbc_options_and_statements():
    target = jdbc.JdbcTarget("jdbc:postgresql://h/db", "u", "secret", extra={"ssl": "true"})
    assert target.properties["batchsize"] == "5000" and target.properties["isolationLevel"] == "READ_COMMITTED"
    assert target.properties["ssl"] == "true" and "secret" not in repr(target)
    assert jdbc.upsert_statement("s", "t", ["k"], ["k", "a", "b"]) == (
        "INSERT INTO t (k, a, b) SELECT k, a, b FROM s ON CONFLICT (k) DO UPDATE SET a = EXCLUDED.a, b = EXCLUDED.b"
    )
    assert jdbc.upsert_statement("s", "t", ["k"], ["k"]).endswith("DO NOTHING")
    assert jdbc.drop_statement("s") == "DROP TABLE IF EXISTS s"


class _Calls:
    """Records the one writer call made through it."""

    def __init__(self):
        self.seen = {}

    def jdbc(self, url, table, **options):
        self.seen = {"url": url, "table": table, **options}


class _Frame:
    def __init__(self):
        self.write = _Calls()

    def repartition(self, n):
        self.parts = n
        return self


def test_jdbc_write_modes():
    target, frame = jdbc.JdbcTarget("jdbc:x", "u", "p"), _Frame()
    jdbc.write_staging(frame, target, "_staging_t")
    assert frame.write.seen["mode"] == "overwrite" and frame.write.seen["table"] == "_staging_t"
    assert frame.parts == target.connections
    jdbc.append(frame, target, "t")
    assert frame.write.seen["mode"] == "append" and frame.write.seen["properties"]["batchsize"] == "5000"


class _Session:
    """Stands in for a session whose reader and gateway only record calls."""

    def __init__(self):
        self.read = _Calls()
        self.log = []
        connection = SimpleNamespace(
            createStatement=lambda: SimpleNamespace(
                executeUpdate=lambda text: self.log.append(text) or 3, close=lambda: self.log.append("closed")
            ),
            close=lambda: self.log.append("disconnected"),
        )
        manager = SimpleNamespace(getConnection=lambda url, user, password: connection)
        self._jvm = SimpleNamespace(java=SimpleNamespace(sql=SimpleNamespace(DriverManager=manager)))


def test_jdbc_reads_in_ranges():
    target, session = jdbc.JdbcTarget("jdbc:x", "u", "p", connections=8), _Session()
    jdbc.read_table(session, target, "t", "id", (1, 100))
    seen = session.read.seen
    assert (seen["column"], seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == ("id", 1, 100, 8)
    jdbc.read_table(session, target, "t")
    assert "column" not in session.read.seen


def test_jdbc_statements_close_what_they_open():
    session = _Session()
    assert jdbc.execute(session, jdbc.JdbcTarget("jdbc:x", "u", "p"), "DROP TABLE IF EXISTS s") == 3
    assert session.log == ["DROP TABLE IF EXISTS s", "closed", "disconnected"]


def test_scratch_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or scratch_dir(spark) == named.rstrip("/")


# --- serving parameters ---


def test_malformed_dates_mean_latest():
    assert serving.parse_day("2026-13-01") is None and serving.parse_day(None) is None and serving.parse_day("") is None
    assert serving.parse_day("2026-01-02") == day("2026-01-02")


def test_latest_of_an_empty_table_is_today(spark):
    empty = spark.createDataFrame([], "date date, x int")
    assert serving.on_latest(empty).count() == 0
    assert spark.range(1).select(serving.latest(empty) == F.current_date()).first()[0] is True


def test_kpis_without_scores(spark):
    fact = spark.createDataFrame([(day("2026-01-01"), None)], "date date, vote_average double")
    got = serving.kpis(fact, spark.range(2), spark.range(3)).first()
    assert (got.total_movies, got.total_genres, got.trending_today, got.avg_rating) == (2, 3, 1, 0.0)


def test_paging(spark):
    ordered = spark.range(45).orderBy("id")
    assert [serving.page(ordered, n).count() for n in (1, 3, 4)] == [20, 5, 0]


def test_listing_orders(spark):
    weekly = spark.createDataFrame(
        [(1, "movie", day("2026-01-05"), 3.0), (2, "movie", day("2026-01-12"), 9.0), (3, "tv", day("2026-01-12"), 1.0)],
        "movie_id bigint, media_type string, week_start date, avg_position double",
    )
    assert [r["movie_id"] for r in serving.listing(weekly, "agg_weekly_summary").collect()] == [3, 2, 1]
    films = spark.createDataFrame([(1, None), (2, day("2020-01-01")), (3, day("2021-01-01"))], "movie_id bigint, release_date date")
    cast = films.select("movie_id", F.lit(7).alias("person_id"), F.lit("t").alias("title"))
    listed = serving.filmography(cast.drop("title"), films.withColumn("title", F.lit("t")))
    assert [r["movie_id"] for r in listed.collect()] == [3, 2, 1]


def test_checked_merges_refuse_bad_rows_and_fill_defaults(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    titles = spark.createDataFrame([(1, "One"), (2, "Two")], "movie_id bigint, title string")
    keep = lambda old, new: merge.upsert(old, new, ["movie_id"])
    assert warehouse.merge_checked("dim_movies", titles, keep) == 2
    assert rows(warehouse.read("dim_movies"), "movie_id", "overview", "budget") == [(1, "", 0), (2, "", 0)]
    day = dt.date(2024, 1, 1)
    schema = "movie_id bigint, media_type string, date date, position int"
    facts = lambda *found: spark.createDataFrame(found, schema)
    add = lambda old, new: merge.upsert(old, new, ["movie_id", "date", "media_type"])
    for bad, reason in (((9, "movie", day, 1), "unknown movie_id"), ((1, "movie", day, None), "no position")):
        with pytest.raises(QualityError, match=reason):
            warehouse.merge_checked("fact_daily_trends", facts((1, "tv", day, 1), bad), add)
    assert warehouse.read("fact_daily_trends").count() == 0
    assert warehouse.merge_checked("fact_daily_trends", facts((1, "tv", day, 1), (2, "tv", day, 2)), add) == 2
    assert rows(warehouse.read("fact_daily_trends"), "movie_id", "vote_count", "popularity") == [(1, 0, 0.0), (2, 0, 0.0)]
