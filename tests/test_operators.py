"""Cleaning, trends, roll-ups and finances on literal rows."""

import pytest
from pyspark.sql import functions as F

from conftest import TITLES, day, rows
from marquee.contracts import MOVIE, PERSON, TV
from marquee.operators import clean, finance, rollups, trends


# --- cleaning ---


def test_clean_keeps_all_titles(titles):
    kept = clean.clean_titles(titles, MOVIE, "_position")
    assert kept.count() == 3 and dict(kept.dtypes)["id"] == "bigint"
    assert rows(kept, "id", "release_date")[0] == (155, day("2008-07-18"))


def test_clean_drops_null_ids(spark):
    df = spark.createDataFrame([(None, "Test", 1), (1, "Good", 2)], "id bigint, title string, _n int")
    assert rows(clean.clean_titles(df, MOVIE, "_n"), "title") == [("Good",)]


def test_clean_keeps_the_last_duplicate(spark):
    df = spark.createDataFrame([(1, "First", 1), (1, "Duplicate", 2)], "id bigint, title string, _n int")
    assert rows(clean.clean_titles(df, MOVIE, "_n"), "title") == [("Duplicate",)]


@pytest.mark.parametrize("budget, revenue, roi", [("100000000", "500000000", 400.0), ("0", "100", None), ("x", "1", None)])
def test_clean_prices_titles(spark, budget, revenue, roi):
    df = spark.createDataFrame([(1, budget, revenue, 1)], "id bigint, budget string, revenue string, _n int")
    assert rows(clean.clean_titles(df, MOVIE, "_n"), "roi") == [(roi,)]


def test_clean_shows(spark):
    df = spark.createDataFrame(
        [(1, None, "2010-99-01", "x", 1)], "id bigint, name string, first_air_date string, popularity string, _n int"
    )
    assert rows(clean.clean_titles(df, TV, "_n"), "name", "first_air_date", "popularity") == [("", None, 0.0)]


def test_defaults_differ_for_people(spark):
    df = spark.createDataFrame([(1, None, None)], "id bigint, popularity double, vote_average double")
    assert rows(clean.fill_defaults(df, MOVIE)) == [(1, 0.0, 0.0)]
    assert rows(clean.fill_defaults(df, PERSON)) == [(1, 0.0, None)]


def test_unify_takes_the_shared_columns(spark):
    movies = spark.createDataFrame([(1, "A", 9)], "id bigint, title string, runtime int")
    shows = spark.createDataFrame([(1, "B")], "id bigint, name string")
    assert rows(clean.unify(movies, shows), "id", "title", "media_type") == [(1, "A", "movie"), (1, "B", "tv")]


def test_genres_without_ids(spark):
    assert rows(clean.add_genres(spark.range(1)), "genres") == [([],)]


# --- trends ---

CONTENT = "id bigint, media_type string, extraction_date date, popularity double, vote_average double, vote_count bigint"


def content(spark, *items):
    return spark.createDataFrame([(i, m, day(d), p, v, n) for i, m, d, p, v, n in items], CONTENT)


def test_daily_trends_separate_media_types_and_span_gaps(spark):
    df = content(
        spark,
        (1, "movie", "2026-01-01", 10.0, 5.0, 1),
        (1, "tv", "2026-01-02", 30.0, 5.0, 1),
        (2, "movie", "2026-01-01", 20.0, 5.0, 1),
        (1, "movie", "2026-01-09", 25.5, 5.0, 1),
    )
    got = rows(
        trends.daily_trends(df), "media_type", "id", "extraction_date", "position", "prev_position", "position_change",
        "popularity_delta", "is_new_entry", "days_on_chart",
    )
    assert got == [
        ("movie", 1, day("2026-01-01"), 2, None, None, None, True, 1),
        ("movie", 1, day("2026-01-09"), 1, 2, 1, 15.5, False, 2),
        ("movie", 2, day("2026-01-01"), 1, None, None, None, True, 1),
        ("tv", 1, day("2026-01-02"), 1, None, None, None, True, 1),
    ]


def test_equal_popularity_shares_a_position(spark):
    df = content(spark, *[(i, "movie", "2026-01-01", p, 5.0, 1) for i, p in ((1, 9.0), (2, 9.0), (3, 1.0))])
    assert rows(trends.daily_positions(df), "id", "position") == [(1, 1), (2, 1), (3, 2)]


def test_changes_between_days(spark, titles):
    current = titles.select("id", F.lit("movie").alias("media_type"), F.col("_position").alias("position"))
    previous = spark.createDataFrame([(27205, "movie", 3), (155, "movie", 1)], "id bigint, media_type string, position int")
    changes = trends.changes_between(current, previous, ["id", "media_type"])
    assert rows(changes, "id", "position_change") == [(155, -1), (27205, 2), (872585, 0)]
    assert {r[0] for r in rows(trends.changes_between(current, previous.limit(0), ["id", "media_type"]), "position_change")} == {0}


def test_position_changes_default_to_zero(spark):
    df = spark.createDataFrame(
        [(1, "movie", day("2026-01-01"), 3), (1, "movie", day("2026-01-02"), 1), (1, "tv", day("2026-01-03"), 9)],
        "movie_id bigint, media_type string, date date, position int",
    )
    got = rows(trends.position_changes(df, ["movie_id", "media_type"]), "date", "position_change")
    assert [change for _, change in got] == [0, 2, 0]


def test_rolling_averages_by_rows_and_by_days(spark):
    days = ["2026-01-01", "2026-01-30", "2026-01-31", "2026-03-15"]
    df = content(spark, *[(1, "movie", d, float(i), float(i) if i != 2 else None, i) for i, d in enumerate(days)])
    got = rows(
        trends.rolling_averages(df), "extraction_date", "rolling_7d_avg_popularity", "rolling_7d_data_points",
        "rolling_30d_avg_vote_average", "rolling_30d_data_points", "rolling_7d_avg_vote_count",
    )
    assert [r[1:] for r in got] == [
        (0.0, 1, 0.0, 1, 0.0), (0.5, 2, 0.5, 2, 0.5), (1.0, 3, 1.0, 1, 1.0), (1.5, 4, 3.0, 1, 1.5),
    ]


def long_history(spark):
    """Titles on some days only, over four months."""
    days = spark.range(120).withColumn("extraction_date", F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")))
    wide = days.select("extraction_date", F.explode(F.sequence(F.lit(1), F.lit(9)).cast("array<bigint>")).alias("id"))
    seen = wide.filter(F.abs(F.hash("id", "extraction_date")) % (F.col("id") * 3) == 0)
    return seen.withColumns(
        {
            "media_type": F.lit("movie"),
            "popularity": F.abs(F.hash("extraction_date", "id")) % 50 / 10,
            "vote_average": F.when(F.hash("id", "extraction_date") % 5 != 0, F.abs(F.hash("id", "extraction_date")) % 10 / 1.0),
            "vote_count": (F.abs(F.hash("id")) % 7).cast("bigint"),
        }
    )


@pytest.mark.parametrize("since", ["2026-01-01", "2026-02-03", "2026-04-30"])
def test_later_days_alone_equal_the_whole(spark, since):
    df, first = long_history(spark), F.lit(since).cast("date")
    day = F.col("extraction_date")
    whole = trends.daily_trends(df)
    columns = whole.columns
    extended = trends.extend_daily_trends(whole.filter(day < first), df.filter(day >= first))
    assert rows(extended, *columns) == rows(whole.filter(day >= first), *columns)
    rolled = trends.rolling_averages(df)
    assert rows(trends.rolling_averages_since(df, first), *rolled.columns) == rows(rolled.filter(day >= first))


# --- roll-ups ---

FACT = "movie_id bigint, media_type string, date date, position int, popularity double, vote_average double"


def weekly_fact(spark):
    measures = [(1, 1, 100.0), (1, 2, 95.0), (1, 1, 110.0), (2, 5, 50.0), (2, 3, 55.0)]
    items = [(m, "movie", day(f"2026-06-{23 + i}"), p, pop, 7.0) for i, (m, p, pop) in enumerate(measures)]
    return spark.createDataFrame(items, FACT)


def test_weekly_summary(spark):
    got = rows(rollups.weekly_summary(weekly_fact(spark)))
    assert got == [(1, "movie", day("2026-06-22"), 3, 1.3, 1, 101.7), (2, "movie", day("2026-06-22"), 2, 4.0, 3, 52.5)]


def test_weekly_summary_of_nothing(spark):
    assert rows(rollups.week_over_week(rollups.weekly_summary(weekly_fact(spark).limit(0)))) == []


def test_week_over_week_needs_a_positive_base(spark):
    weekly = spark.createDataFrame(
        [(1, "movie", day("2026-06-01"), 0.0), (1, "movie", day("2026-06-08"), 10.0), (1, "movie", day("2026-06-22"), 12.5),
         (1, "tv", day("2026-06-29"), 3.0)],
        "movie_id bigint, media_type string, week_start date, avg_popularity double",
    )
    got = rows(rollups.week_over_week(weekly), "week_start", "popularity_change_pct")
    assert [change for _, change in got] == [0.0, 0.0, 25.0, 0.0]


def test_weekly_rankings_keep_ties_and_cut_ranks(spark):
    df = content(spark, *[(i, "movie", "2026-01-01", float(100 - i // 2), 5.0, 1) for i in range(60)])
    df = df.withColumns({"title": F.col("id").cast("string"), "genres": F.array(F.lit("Drama"))})
    got = rollups.weekly_rankings(df)
    assert got.count() == 40 and got.agg(F.max("weekly_rank")).first()[0] == 20


def genre_rows(spark):
    df = content(
        spark,
        (1, "movie", "2026-01-01", 10.0, 5.0, 1),
        (1, "movie", "2026-01-02", 20.0, 6.0, 2),
        (2, "tv", "2026-01-03", 20.0, None, 4),
        (3, "movie", "2026-01-03", 5.0, 1.0, 8),
    )
    genres = F.when(F.col("id") == 3, F.lit(None)).otherwise(F.array(F.lit("Drama"), F.lit(None)))
    return df.withColumns({"title": F.concat(F.lit("t"), F.col("id").cast("string")), "genres": genres})


def test_monthly_genre_stats(spark):
    got = rollups.monthly_genre_stats(genre_rows(spark)).first().asDict()
    assert got == {
        "genre": "Drama", "year_month": "2026-01", "title_count": 2, "total_vote_count": 7, "peak_popularity": 20.0,
        "top_title": "t1", "avg_popularity": 16.67, "avg_vote_average": 5.5,
    }


def test_monthly_genres_counts_money_per_daily_row(spark):
    fact = weekly_fact(spark)
    bridge = spark.createDataFrame([(1, 28), (2, 28), (2, 18), (9, 99)], "movie_id bigint, genre_id int")
    money = spark.createDataFrame([(1, 100, 300)], "movie_id bigint, budget bigint, revenue bigint")
    got = rows(
        rollups.monthly_genres(fact, bridge, money), "genre_id", "month", "trending_count", "avg_popularity",
        "top_movie_id", "total_budget", "total_revenue", "avg_roi",
    )
    assert got == [
        (18, day("2026-06-01"), 1, 52.5, 2, None, None, None),
        (28, day("2026-06-01"), 2, 82.0, 1, 300, 900, 200.0),
    ]


def test_daily_genre_trends_move_over_thirty_rows(spark):
    first = day("2026-01-01")
    days = spark.range(40).select(
        F.lit(1).cast("bigint").alias("movie_id"),
        F.date_add(F.lit(str(first)).cast("date"), F.col("id").cast("int")).alias("date"),
        F.col("id").cast("double").alias("popularity"),
        F.lit(5.0).alias("vote_average"),
    )
    genres = spark.createDataFrame([(1, 28, "Action")], "movie_id bigint, genre_id int, genre_name string")
    got = rows(rollups.daily_genre_trends(days, genres), "date", "avg_popularity", "avg_popularity_30d")
    assert got[0][1:] == (0.0, 0.0) and got[-1][1:] == (39.0, 24.5)


# --- finances ---


def priced(spark, *items):
    schema = "id bigint, genres array<string>, release_date date, budget double, revenue double, extraction_date date"
    return spark.createDataFrame([(i, g, day(r), b, v, day(x)) for i, g, r, b, v, x in items], schema)


def test_roi_analysis(spark):
    df = priced(
        spark,
        (1, ["A", "B"], "2020-01-01", 100.0, 300.0, "2026-01-01"),
        (1, ["A", "B"], "2020-01-01", 100.0, 400.0, "2026-01-02"),
        (2, ["A"], "2020-01-01", 200.0, 0.0, "2026-01-01"),
        (3, [], "2021-01-01", 3.0, 4.0, "2026-01-01"),
        (4, ["A"], "2021-01-01", 0.0, 4.0, "2026-01-01"),
        (5, ["A"], "2021-01-01", 5.0, None, "2026-01-01"),
    )
    got = rows(finance.roi_analysis(df), "id", "genre", "roi", "profit_margin_pct", "roi_genre_rank", "rolling_avg_roi")
    assert got == [
        (1, "A", 3.0, 75.0, 1, 3.0),
        (1, "B", 3.0, 75.0, 1, 3.0),
        (2, "A", -1.0, None, 2, 1.0),
        (3, None, 0.3333, 25.0, 1, 0.3333),
    ]


def test_equal_returns_share_a_rank_and_leave_a_gap(spark):
    df = priced(spark, *[(i, ["A"], "2020-01-01", 10.0, v, "2026-01-01") for i, v in ((1, 20.0), (2, 20.0), (3, 15.0))])
    assert rows(finance.roi_ranked(df), "id", "roi_genre_rank") == [(1, 1), (2, 1), (3, 3)]


def test_rolling_roi_covers_ten_releases(spark):
    df = priced(spark, *[(i, ["A"], f"2020-01-{i:02d}", 10.0, 10.0 + i, "2026-01-01") for i in range(1, 13)])
    got = rows(finance.roi_analysis(df), "id", "rolling_avg_roi")
    assert got[0][1] == 0.1 and got[9][1] == 0.55 and got[11][1] == 0.75


def test_missing_money_gives_no_rows(spark):
    feed = spark.createDataFrame([(1, ["A"])], "id bigint, genres array<string>")
    assert finance.with_missing_money(feed).columns == ["id", "genres", "budget", "revenue"]
    assert finance.has_finances(finance.with_missing_money(feed)).count() == 0


def test_fixture_titles_are_complete():
    assert [t[0] for t in TITLES] == [27205, 155, 872585]
