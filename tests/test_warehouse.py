"""Versioned tables: safe commits, changed parts only, appended links, deletes along references."""

import pytest
from pyspark.sql import functions as F

from conftest import day, rows
from marquee.contracts import FOREIGN_KEYS
from marquee.operators import merge
from marquee.operators.integrity import dependents
from marquee.operators.quality import QualityError
from marquee.plans import jobs
from marquee.sources import layers
from marquee.sources.commits import SEGMENTS, Conflict, Table, put_if_absent
from marquee.sources.warehouse import Warehouse
from marquee.streaming import bronze

PAIR = "k bigint, v string"


def pairs(spark, *found):
    return spark.createDataFrame(found, PAIR)


def files(path):
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_put_if_absent(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    assert put_if_absent(spark, path, "first") and not put_if_absent(spark, path, "second")
    assert [f.name for f in (tmp_path / "log").iterdir() if not f.name.startswith(".")] == ["1.json"]
    assert (tmp_path / "log" / "1.json").read_text() == "first"


def writer(spark, root):
    return Table(spark, str(root), PAIR, keys=["k"], buckets=8)


def test_two_writers_of_different_parts_both_count(spark, tmp_path):
    one, two = writer(spark, tmp_path), writer(spark, tmp_path)
    a, b = pairs(spark, (1, "a")), pairs(spark, (2, "b"))
    assert one.parts_of(a) != two.parts_of(b)
    calls = []

    def late(old):
        """The other writer publishes while this one computes."""
        calls.append(1)
        if len(calls) == 1:
            two.rewrite(two.parts_of(b), lambda o: o.unionByName(b))
        return old.unionByName(a)

    one.rewrite(one.parts_of(a), late)
    assert len(calls) == 1 and one.newest().version == 2
    assert rows(one.read()) == [(1, "a"), (2, "b")]


def test_two_writers_of_one_part_are_put_in_order(spark, tmp_path):
    one, two = writer(spark, tmp_path), writer(spark, tmp_path)
    add = lambda v: lambda old: merge.upsert(old, pairs(spark, (1, v)), ["k"]).unionByName(pairs(spark))
    parts, calls = one.parts_of(pairs(spark, (1, "x"))), []

    def late(old):
        calls.append(rows(old))
        if len(calls) == 1:
            two.rewrite(parts, add("theirs"))
        return add("ours")(old)

    one.rewrite(parts, late)
    assert calls == [[], [(1, "theirs")]]  # the second time on top of the other writer's rows
    assert rows(two.read()) == [(1, "ours")] and two.newest().version == 2


def test_endless_conflict_fails_and_leaves_the_others_rows(spark, tmp_path, monkeypatch):
    from marquee.sources import commits

    monkeypatch.setattr(commits, "ATTEMPTS", 2)
    one, two = writer(spark, tmp_path), writer(spark, tmp_path)
    parts = one.parts_of(pairs(spark, (1, "x")))

    def beaten(old):
        two.rewrite(parts, lambda o: pairs(spark, (1, "theirs")))
        return pairs(spark, (1, "ours"))

    with pytest.raises(Conflict):
        one.rewrite(parts, beaten)
    assert rows(one.read()) == [(1, "theirs")]


def test_a_failed_write_and_a_stray_part_publish_nothing(spark, tmp_path):
    table = writer(spark, tmp_path)
    table.rewrite(["0", "1", "2", "3", "4", "5", "6", "7"], lambda old: pairs(spark, (1, "a"), (2, "b")))
    with pytest.raises(ZeroDivisionError):
        table.rewrite(["0"], lambda old: 1 / 0)
    with pytest.raises(ValueError, match="rows of others"):
        table.rewrite(table.parts_of(pairs(spark, (1, ""))), lambda old: pairs(spark, (2, "c")))
    assert rows(table.read()) == [(1, "a"), (2, "b")] and table.newest().version == 1


def titles(spark, *found):
    return spark.createDataFrame(found, "movie_id bigint, title string")


def upsert_titles(warehouse, batch):
    return warehouse.merge_checked("dim_movies", batch, lambda old, new: merge.upsert(old, new, ["movie_id"]))


def test_a_dimension_rewrites_only_the_buckets_of_its_batch(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), {"dim_movies": 16})
    many = spark.range(400).select(F.col("id").alias("movie_id"), F.concat(F.lit("t"), "id").alias("title"))
    upsert_titles(warehouse, many)
    before, parts = files(tmp_path / "dim_movies"), warehouse.table("dim_movies").newest().parts
    assert len(parts) == 16
    assert upsert_titles(warehouse, titles(spark, (7, "new"), (1000, "more"))) < 100
    after = files(tmp_path / "dim_movies")
    assert before.items() <= after.items() and 1 <= len(after) - len(before) <= 2
    now = warehouse.table("dim_movies").newest().parts
    assert 1 <= sum(now[p] != parts[p] for p in now) <= 2
    read = warehouse.read("dim_movies")
    assert read.count() == 401 and rows(read.filter("movie_id in (7, 8)"), "title") == [("new",), ("t8",)]


def star(spark, root):
    warehouse = Warehouse(spark, str(root), {"dim_movies": 4, "bridge_movie_genres": 4, "bridge_movie_cast": 4, "dim_people": 4})
    upsert_titles(warehouse, titles(spark, *[(i, f"t{i}") for i in range(1, 7)]))
    jobs.upsert_genres(warehouse, spark.createDataFrame([(1, "a"), (2, "b")], "genre_id int, name string"))
    jobs.upsert_people(warehouse, spark.createDataFrame([(1, "p"), (2, "q")], "person_id bigint, name string"))
    jobs.link(warehouse, "bridge_movie_genres", links(spark, *[(i, i % 2 + 1) for i in range(1, 7)]))
    jobs.link(warehouse, "bridge_movie_cast", spark.createDataFrame([(1, 1, "c", 1), (1, 2, "d", 2), (2, 1, "e", 1)], "movie_id bigint, person_id bigint, character_name string, cast_order int"))
    facts = [(i, "movie", day(d), i) for i in range(1, 7) for d in ("2026-01-01", "2026-01-02") if i < 5 or d == "2026-01-02"]
    jobs.upsert_facts(warehouse, spark.createDataFrame(facts, "movie_id bigint, media_type string, date date, position int").withColumns({n: F.lit(None).cast("int") for n in ("position_change", "vote_count")}).withColumns({n: F.lit(1.0) for n in ("popularity", "vote_average")}))
    top = spark.createDataFrame([(day("2026-01-01"), 1, 5), (day("2026-01-01"), 2, 1)], "month date, genre_id int, top_movie_id bigint")
    warehouse.merge_checked("agg_monthly_genres", top, lambda old, new: merge.replace_by_key(old, new, ["month", "genre_id"]))
    return warehouse


def links(spark, *found):
    return spark.createDataFrame(found, "movie_id bigint, genre_id int")


def test_links_are_appended(spark, tmp_path):
    warehouse = star(spark, tmp_path)
    before = files(tmp_path / "bridge_movie_genres")
    assert jobs.link(warehouse, "bridge_movie_genres", links(spark, (1, 2), (2, 1), (1, 1), (1, 1))) == 1
    after = files(tmp_path / "bridge_movie_genres")
    fresh = [str(f) for f in after if f not in before]
    assert before.items() <= after.items()
    assert rows(spark.read.parquet(*fresh), "movie_id", "genre_id") == [(1, 1)]
    assert jobs.link(warehouse, "bridge_movie_genres", links(spark, (1, 1))) == 0
    assert files(tmp_path / "bridge_movie_genres") == after
    assert warehouse.read("bridge_movie_genres").filter("movie_id = 1").count() == 2


def test_worn_parts_are_rewritten_as_one(spark, tmp_path):
    table = Table(spark, str(tmp_path), PAIR, keys=["v"], buckets=1)
    for i in range(SEGMENTS + 2):
        assert table.append(["0"], lambda old, i=i: pairs(spark, (i, "x"))) == 1
    assert len(table.newest().parts["0"]) == 2 and table.newest().rows() == SEGMENTS + 2
    assert rows(table.read()) == [(i, "x") for i in range(SEGMENTS + 2)]


def test_deletes_follow_references(spark, tmp_path):
    warehouse = star(spark, tmp_path)
    first_day = files(tmp_path / "fact_daily_trends")
    kept = {f: t for f, t in first_day.items() if "date=2026-01-01" in str(f)}
    changed = jobs.retire(warehouse, "dim_movies", titles(spark, (5, ""), (6, ""), (99, "")))
    assert changed == {"bridge_movie_genres cascade": 2, "fact_daily_trends cascade": 2, "agg_monthly_genres set null": 1, "dim_movies": 2}
    assert rows(warehouse.read("dim_movies"), "movie_id") == [(1,), (2,), (3,), (4,)]
    assert {r["movie_id"] for r in warehouse.read("fact_daily_trends").collect()} == {1, 2, 3, 4}
    assert rows(warehouse.read("agg_monthly_genres"), "genre_id", "top_movie_id") == [(1, None), (2, 1)]
    assert kept.items() <= files(tmp_path / "fact_daily_trends").items()
    # Days without the deleted titles are in the same folders as before.
    parts = warehouse.table("fact_daily_trends").newest().parts
    assert any(parts["2026-01-01"][0][0] in str(f) for f in kept)
    assert jobs.retire(warehouse, "dim_people", spark.createDataFrame([(1,)], "person_id bigint")) == {"bridge_movie_cast cascade": 2, "dim_people": 1}
    assert jobs.retire(warehouse, "dim_genres", spark.createDataFrame([(1,)], "genre_id int")) == {"bridge_movie_genres cascade": 2, "agg_monthly_genres cascade": 1, "dim_genres": 1}
    assert jobs.retire(warehouse, "dim_genres", spark.createDataFrame([(1,)], "genre_id int")) == {}


def test_jobs_refuse_what_refers_to_nothing(spark, tmp_path):
    warehouse = star(spark, tmp_path)
    versions = {n: warehouse.table(n).newest().version for n in ("bridge_movie_genres", "fact_daily_trends")}
    with pytest.raises(QualityError, match="unknown genre_id"):
        jobs.link(warehouse, "bridge_movie_genres", links(spark, (1, 1), (1, 77)))
    with pytest.raises(QualityError, match="unknown movie_id"):
        bad = spark.createDataFrame([(77, "movie", day("2026-01-05"), 1, 0, 0.0, 0.0, 0)], "movie_id bigint, media_type string, date date, position int, position_change int, popularity double, vote_average double, vote_count int")
        jobs.upsert_facts(warehouse, bad)
    with pytest.raises(QualityError, match="no title"):
        jobs.upsert_movies(warehouse, titles(spark, (8, None)))
    assert {n: warehouse.table(n).newest().version for n in versions} == versions


def test_references_are_removed_before_they_are_emptied():
    for parent in {f[2] for f in FOREIGN_KEYS}:
        actions = [d[3] for d in dependents(parent)]
        assert actions == sorted(actions, key=lambda a: a != "cascade")


# --- layers ---


def test_schemas_are_read_from_the_manifest(spark, tmp_path):
    table = Table(spark, str(tmp_path), by="d")
    table.add(spark.createDataFrame([(1, "a")], "k bigint, d string"))
    table.add(spark.createDataFrame([(2, "b", 2.5)], "k bigint, d string, more double"))
    assert rows(table.read(), "k", "d", "more") == [(1, "a", None), (2, "b", 2.5)]
    with pytest.raises(ValueError, match="k is bigint, not string"):
        table.add(spark.createDataFrame([("x", "c")], "k string, d string"))
    assert table.read().count() == 2
    for file in tmp_path.rglob("*.parquet"):
        file.write_bytes(b"no footer")  # planning a scan opens none
    assert table.read().filter("d = 'a'").columns == ["k", "d", "more"]


def test_only_parts_asked_for_are_scanned(spark, tmp_path):
    table = Table(spark, str(tmp_path), by=["y", "m"])
    table.add(spark.createDataFrame([(i, 2020 + i % 3, i % 2) for i in range(12)], "k bigint, y int, m int"))
    scan = table.read().filter("y = 2021 and m = 1")
    assert "PartitionFilters: [isnotnull(y" in scan._jdf.queryExecution().executedPlan().toString()
    assert rows(scan, "k") == [(1,), (7,)]


def test_marts_are_switched_at_once(spark, tmp_path):
    path = str(tmp_path / "gold_roi_analysis")
    first = spark.createDataFrame([(1, "old")], "id bigint, title string")
    assert layers.overwrite_gold(first, path, "gold_roi_analysis") == 1
    failing = first.select("id", F.raise_error(F.lit("late")).cast("string").alias("title"))
    with pytest.raises(Exception, match="late"):
        layers.overwrite_gold(failing, path, "gold_roi_analysis")
    assert rows(layers.read_layer(spark, path)) == [(1, "old")]
    # The new version may be made from the old one.
    layers.overwrite_gold(layers.read_layer(spark, path).withColumn("title", F.lit("new")), path, "gold_roi_analysis")
    assert rows(layers.read_layer(spark, path)) == [(1, "new")]
    with pytest.raises(layers.NoTable):
        layers.read_layer(spark, str(tmp_path / "nothing"))


def test_partitions_of_a_mart_are_replaced(spark, tmp_path):
    path, schema = str(tmp_path / "gold_daily_trends"), "id bigint, extraction_date date"
    layers.overwrite_gold(spark.createDataFrame([(1, day("2026-01-01")), (2, day("2026-01-02"))], schema), path, "gold_daily_trends")
    fresh = spark.createDataFrame([(3, day("2026-01-02"))], schema)
    assert layers.overwrite_gold(fresh, path, "gold_daily_trends", whole=False) == 1
    assert rows(layers.read_layer(spark, path), "id") == [(1,), (3,)]


def test_a_batch_sent_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "bronze")
    batch = spark.createDataFrame([(1, day("2026-01-01"))], "id bigint, _extraction_date date")
    assert [bronze.add_batch(batch, "s", n, path) for n in (0, 0, 1, 0)] == [1, 0, 1, 0]
    assert bronze.add_batch(batch, "other", 0, path) == 1
    assert rows(layers.read_layer(spark, path), "_batch_id") == [("other-0",), ("s-0",), ("s-1",)]


def test_a_lost_stream_commit_is_made_good(spark, tmp_path):
    """The table has a batch that the stream's checkpoint does not know of: the stream sends it again."""
    from marquee.sources import landing

    base = str(tmp_path)
    landing.write_landing(spark.createDataFrame([(1, day("2026-01-01"))], "id bigint, date date"), base, "trending_people")
    run = lambda: bronze.ingest_available(spark, base, "trending_people", "feed", f"{base}/bronze", f"{base}/progress")
    run()
    before = layers.read_layer(spark, f"{base}/bronze").count()
    for file in ("0", ".0.crc"):
        (tmp_path / "progress" / "commits" / file).unlink()
    run()
    assert layers.read_layer(spark, f"{base}/bronze").count() == before == 1


def test_a_feed_without_a_field_fails_by_its_name(spark, tmp_path):
    from marquee.operators import quality
    from marquee.sources import landing

    def land(feed, text):
        folder = tmp_path / "raw" / feed / "date=2026-01-01"
        folder.mkdir(parents=True)
        (folder / "data.json").write_text(text)

    land("trending_people", '{"id": 1, "name": null, "extra": {"a": 1}}\n{broken\n\n{"id": 2, "popularity": 3.5}\n')
    census = landing.field_census(spark, str(tmp_path), "trending_people", "2026-01-01")
    assert rows(census, "field", "records") == [("extra", 1), ("id", 2), ("name", 1), ("popularity", 1)]
    with pytest.raises(QualityError, match="known_for_department"):
        quality.require_fields(census, "person")
    land("trending_tv", '[{"id": 1, "name": "a"}, {"id": 2, "vote_count": [1]}]')
    census = landing.field_census(spark, str(tmp_path), "trending_tv", "2026-01-01", json_array=True)
    assert rows(census, "field", "records") == [("id", 2), ("name", 1), ("vote_count", 1)]
    reports = {r["table"]: r for r in jobs.raw_to_bronze(spark, str(tmp_path), day("2026-01-01"))}
    assert reports["trending_people"]["status"] == "FAILED" and "known_for_department" in reports["trending_people"]["error"]


def test_a_page_reads_its_own_days(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    days = [day(f"2026-01-0{d}") for d in range(1, 6)]
    found = [(i, "movie", d, i) for n, d in enumerate(days) for i in range(1, 4 + n)]  # 3, 4, 5, 6 and 7 rows
    facts = spark.createDataFrame(found, "movie_id bigint, media_type string, date date, position int")
    warehouse.merge("fact_daily_trends", facts, lambda old, new: merge.upsert(old, new, ["movie_id", "date", "media_type"]))
    order = sorted((d, i) for i, _, d, _ in found)
    for size in (4, 10):
        for number in range(1, 9):
            page = warehouse.page("fact_daily_trends", number, size)
            assert [(r["date"], r["movie_id"]) for r in page.collect()] == order[(number - 1) * size : number * size]
    third = warehouse.page("fact_daily_trends", 2, 4)  # rows 5 to 8: all of the second day, the first of the third
    assert {f.split("date=")[1][:10] for f in third.inputFiles()} == {"2026-01-02", "2026-01-03"}
    weekly = spark.createDataFrame([(i, "movie", d, float(i)) for i in (1, 2) for d in days], "movie_id bigint, media_type string, week_start date, avg_position double")
    warehouse.merge("agg_weekly_summary", weekly, lambda old, new: new)
    assert [r["week_start"] for r in warehouse.page("agg_weekly_summary", 2, 3).collect()] == [days[3], days[2], days[2]]
    assert warehouse.page("dim_genres", 1).count() == 0
