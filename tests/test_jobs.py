"""The jobs end to end on a few landed days."""

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import day, rows
from marquee.contracts import GOLD_PARTITIONS
from marquee.plans import jobs
from marquee.sources import jdbc, layers
from marquee.sources.warehouse import Warehouse

BASE = "https://images.example.org/t"


def land(root, feed, text, records):
    folder = root / "raw" / feed / f"date={text}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "data.json").write_text("".join(json.dumps(r) + "\n" for r in records))


def movie(key, popularity, **extra):
    return {"id": key, "title": f"M{key}", "popularity": popularity, "vote_average": 8.0, "vote_count": 10,
            "release_date": "2010-07-16", "genre_ids": [28, 99999], **extra}


def show(key, popularity):
    return {"id": key, "name": f"S{key}", "popularity": popularity, "vote_average": 7.0, "vote_count": 5,
            "first_air_date": "2011-01-01", "genre_ids": [18]}


@pytest.fixture(scope="module")
def layered(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for text, lift in (("2026-06-28", 0), ("2026-06-29", 20)):
        land(root, "trending_movies", text, [movie(1, 50 + lift), movie(1, 50 + lift), movie(2, 60, budget="10", revenue=30.0), movie(3, 1, budget="n/a", revenue="1")])
        land(root, "trending_tv", text, [show(1, 40)])
        land(root, "trending_people", text, [{"id": 7, "name": "P", "popularity": "x", "known_for_department": "Acting"}])
    base, days = str(root), [day("2026-06-28"), day("2026-06-29")]
    ingested = [jobs.raw_to_bronze(spark, base, d) for d in days]
    refined = [jobs.bronze_to_silver(spark, base, days) for _ in range(2)]
    built = jobs.silver_to_gold(spark, base)
    return spark, base, ingested, refined, built


def test_layer_reports(layered):
    _, _, ingested, refined, built = layered
    assert [[r["rows_written"] for r in run] for run in ingested] == [[4, 1, 1], [4, 1, 1]]
    assert all(r["status"] == "SUCCESS" for run in (*ingested, *refined, built) for r in run)
    assert [r["rows_written"] for r in refined[1]] == [6, 2, 2]


def test_silver_is_one_row_per_title_and_day(layered):
    spark, base, *_ = layered
    movies = layers.read_layer(spark, f"{base}/silver/trending_movies")
    assert rows(movies, "id", "extraction_date", "genres")[0] == (1, day("2026-06-28"), ["Action"])
    assert movies.count() == 6 and "_corrupt_record" not in movies.columns
    people = layers.read_layer(spark, f"{base}/silver/trending_people")
    assert {r[0] for r in rows(people, "popularity")} == {0.0}


def test_gold_tables(layered):
    spark, base, *_ = layered
    daily = layers.read_layer(spark, f"{base}/gold/gold_daily_trends")
    risen = daily.filter((F.col("id") == 1) & (F.col("media_type") == "movie") & (F.col("extraction_date") == "2026-06-29"))
    assert rows(risen, "position", "position_change", "popularity_delta") == [(1, 1, 20.0)]
    roi = layers.read_layer(spark, f"{base}/gold/gold_roi_analysis")
    assert rows(roi, "id", "genre", "roi") == [(2, "Action", 2.0)]
    weekly = layers.read_layer(spark, f"{base}/gold/gold_weekly_rankings")
    assert set(rows(weekly, "year_week")) == {("2026-W26",), ("2026-W27",)}


def test_gold_from_a_day_on_equals_the_whole(layered):
    spark, base, *_ = layered
    names = [n for n, partitions in GOLD_PARTITIONS.items() if partitions]
    before = {n: rows(layers.read_layer(spark, f"{base}/gold/{n}").drop("_ingested_at", "_batch_id")) for n in names}
    reports = jobs.silver_to_gold(spark, base, day("2026-06-29"))
    assert all(r["status"] == "SUCCESS" for r in reports), reports
    for n in names:
        assert rows(layers.read_layer(spark, f"{base}/gold/{n}").drop("_ingested_at", "_batch_id")) == before[n], n


def test_new_days_follow_the_kept_state(spark, tmp_path):
    """A further day is built from the state of each title: the days before it are not read again."""
    base, days = str(tmp_path), [day("2026-06-28"), day("2026-06-29"), day("2026-06-30")]
    for d, lift in zip(days, (0, 20, 5)):
        land(tmp_path, "trending_movies", str(d), [movie(1, 50 + lift), movie(2, 60), *([movie(3, 70)] if lift else [])])
        land(tmp_path, "trending_tv", str(d), [show(1, 40)])
        land(tmp_path, "trending_people", str(d), [])
        jobs.raw_to_bronze(spark, base, d)
    jobs.bronze_to_silver(spark, base, days[:2])
    jobs.silver_to_gold(spark, base)
    state = layers.read_layer(spark, f"{base}/gold/{jobs.STATE}")
    assert rows(state, "media_type", "id", "_days", "until") == [("movie", 1, 2, days[1]), ("movie", 2, 2, days[1]), ("movie", 3, 1, days[1]), ("tv", 1, 2, days[1])]
    jobs.bronze_to_silver(spark, base, days[2:])
    read = layers.read_layer(spark, f"{base}/gold/gold_daily_trends")
    before = rows(read.drop("_ingested_at", "_batch_id"))
    old = [f for f in (tmp_path / "gold" / "gold_daily_trends").rglob("*.parquet")]
    held = {f: f.read_bytes() for f in old}
    for f in old:
        f.write_bytes(b"unreadable")
    reports = {r["table"]: r for r in jobs.silver_to_gold(spark, base, days[2])}
    for f, content in held.items():
        f.write_bytes(content)
    assert reports["gold_daily_trends"]["status"] == "SUCCESS", reports
    extended = layers.read_layer(spark, f"{base}/gold/gold_daily_trends").drop("_ingested_at", "_batch_id")
    assert rows(extended.filter(F.col("extraction_date") < days[2])) == before
    assert rows(layers.read_layer(spark, f"{base}/gold/{jobs.STATE}"), "_days", "until")[-1] == (3, days[2])
    fresh = rows(extended.filter(F.col("extraction_date") == days[2]), "media_type", "id", "prev_position", "days_on_chart")
    jobs.silver_to_gold(spark, base)
    whole = layers.read_layer(spark, f"{base}/gold/gold_daily_trends")
    assert rows(whole.filter(F.col("extraction_date") == days[2]), "media_type", "id", "prev_position", "days_on_chart") == fresh


def test_a_failed_feed_does_not_stop_the_others(spark, tmp_path):
    land(tmp_path, "trending_tv", "2026-06-29", [show(1, 1.0)])
    land(tmp_path, "trending_people", "2026-06-29", [])
    reports = jobs.raw_to_bronze(spark, str(tmp_path), day("2026-06-29"))
    assert [r["status"] for r in reports] == ["FAILED", "SUCCESS", "EMPTY"]
    with pytest.raises(AnalysisException):
        jobs.raw_to_bronze(spark, str(tmp_path), day("2026-06-29"), strict=True)
    summary = layers.run_summary(spark, reports)
    assert rows(summary, "table", "rows_written") == [
        ("trending_movies", None), ("trending_people", 0), ("trending_tv", 1),
    ]


def feed(spark, records, schema):
    return spark.createDataFrame(records, schema)


def load_day(spark, warehouse, when, movies):
    titles = feed(
        spark,
        [(i, f"M{i}", "en", "o", "2010-07-16", str(p), "8.0", "10", [28], "/p.jpg", None, n) for n, (i, p) in enumerate(movies, 1)],
        "id bigint, title string, original_language string, overview string, release_date string, popularity string, "
        "vote_average string, vote_count string, genre_ids array<int>, poster_path string, backdrop_path string, _position int",
    )
    shows = feed(
        spark,
        [(50, "S50", "en", "o", "", "1", "7.0", "5", [18], None, None, 1)],
        "id bigint, name string, original_language string, overview string, first_air_date string, popularity string, "
        "vote_average string, vote_count string, genre_ids array<int>, poster_path string, backdrop_path string, _position int",
    )
    people = feed(
        spark, [(7, "P", "3.5", "Acting", "/f.jpg")],
        "id bigint, name string, popularity string, known_for_department string, profile_path string",
    )
    genres = feed(spark, [(28, "Action"), (18, "Drama")], "genre_id int, name string")
    return jobs.daily_load(warehouse, titles, shows, people, genres, when, BASE)


def test_star_schema_jobs(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load_day(spark, warehouse, day("2026-05-31"), [(3, 9.0), (1, 8.0), (2, 7.0)])
    for _ in range(2):
        counts = load_day(spark, warehouse, day("2026-06-01"), [(1, 9.5), (3, 8.5)])
    assert counts == {"facts": 3, "movies": 4, "genres": 2}

    facts = warehouse.read("fact_daily_trends")
    today = facts.filter(F.col("date") == "2026-06-01")
    assert rows(today, "movie_id", "media_type", "position", "position_change") == [
        (1, "movie", 1, 1), (3, "movie", 2, -1), (50, "tv", 1, 0),
    ]
    movies = warehouse.read("dim_movies")
    assert rows(movies.filter("movie_id in (1, 50)"), "movie_id", "title", "release_date", "poster_url") == [
        (1, "M1", day("2010-07-16"), f"{BASE}/w500/p.jpg"), (50, "S50", None, ""),
    ]
    assert rows(warehouse.read("bridge_movie_genres"))[-1] == (50, 18)
    assert rows(warehouse.read("dim_people"), "person_id", "profile_url") == [(7, f"{BASE}/w185/f.jpg")]

    for _ in range(2):
        jobs.weekly_refresh(warehouse, day("2026-06-02"))
    weekly = warehouse.read("agg_weekly_summary").filter("movie_id = 1")
    assert rows(weekly, "week_start", "avg_popularity", "popularity_change_pct") == [
        (day("2026-05-25"), 8.0, 0.0), (day("2026-06-01"), 9.5, 18.8),
    ]

    assert jobs.monthly_refresh(warehouse, day("2026-06-20")) == 2
    monthly = warehouse.read("agg_monthly_genres")
    assert rows(monthly, "month", "genre_id", "trending_count", "top_movie_id") == [
        (day("2026-05-01"), 18, 1, 50), (day("2026-05-01"), 28, 3, 3),
    ]

    details = spark.createDataFrame(
        [(1, "M1x", "fr", "o", "2010-07-16", 148, "100", "350", None, None,
          ([(7, "P7", None, 0, "Directing", 2.0), (8, "P8", "Role", 1, None, None), (9, "P9", "x", 2, None, None)],))],
        "id bigint, title string, original_language string, overview string, release_date string, runtime int, "
        "budget string, revenue string, poster_path string, backdrop_path string, "
        "credits struct<cast: array<struct<id: bigint, name: string, character: string, order: int, "
        "known_for_department: string, popularity: double>>>",
    )
    jobs.enrich(warehouse, details, BASE, billed=2)
    enriched = warehouse.read("dim_movies").filter("movie_id = 1")
    assert rows(enriched, "title", "original_language", "runtime", "roi") == [("M1x", "en", 148, 250.0)]
    assert rows(warehouse.read("dim_people"), "person_id", "name", "known_for_department") == [
        (7, "P7", "Acting"), (8, "P8", ""),
    ]
    assert rows(warehouse.read("bridge_movie_cast")) == [(1, 7, "", 0), (1, 8, "Role", 1)]


def test_a_day_without_facts_fails(spark, tmp_path):
    from marquee.operators.quality import QualityError, load_counts, require_load

    warehouse = Warehouse(spark, str(tmp_path))
    counts = load_counts(
        warehouse.read("fact_daily_trends"), warehouse.read("dim_movies"), warehouse.read("dim_genres"),
        F.lit(str(dt.date(2026, 1, 1))).cast("date"),
    ).first()
    with pytest.raises(QualityError):
        require_load(counts.asDict())


def test_export_stages_upserts_and_checks(layered, monkeypatch):
    """The sequence of calls; no database takes part."""
    spark, base, *_ = layered
    calls = []
    monkeypatch.setattr(jdbc, "write_staging", lambda df, target, table: calls.append(("stage", table, df.columns)))
    monkeypatch.setattr(jdbc, "row_count", lambda s, target, table: 4)
    monkeypatch.setattr(jdbc, "execute", lambda s, target, text: calls.append(("run", text.split()[0])))
    reports = jobs.export_marts(spark, base, jdbc.JdbcTarget("jdbc:x", "u", "p"))
    assert [r["status"] for r in reports] == ["SUCCESS"] * 5 and jobs.export_outcome(reports) == "success"
    assert [c[:2] for c in calls[:3]] == [("stage", "public._staging_daily_trends"), ("run", "INSERT"), ("run", "DROP")]
