"""Queries behind the dashboard and the API, over the star schema.

Latest-day lookups are scalar subqueries: on a table partitioned by day they
prune to one partition. A limit is always an ordered top-k.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.contracts import ENRICH_TITLES, LISTING_ORDER, PAGE_ROWS, SHOWN_CAST
from marquee.functions.exact import fixed, mean, percent
from marquee.functions.labels import bubble_size, short_title
from marquee.operators.keys import top_rows


def latest(df: DataFrame, column: str = "date") -> Column:
    """The newest value of a column; today if the table is empty."""
    return F.coalesce(df.agg(F.max(column)).scalar(), F.current_date())


def on_latest(df: DataFrame, column: str = "date", newest: Column | None = None) -> DataFrame:
    return df.filter(F.col(column) == (latest(df, column) if newest is None else newest))


def parse_day(text: str | None) -> dt.date | None:
    """A date parameter; None when absent or malformed, which means the latest day."""
    try:
        return dt.date.fromisoformat(text) if text else None
    except ValueError:
        return None


def of_period(df: DataFrame, column: str, text: str | None) -> DataFrame:
    """Rows of the day, week or month that a parameter names: all without one, the newest one's if it is malformed."""
    if not text:
        return df
    wanted = parse_day(text)
    return on_latest(df, column) if wanted is None else df.filter(F.col(column) == F.lit(wanted))


def daily_page(
    fact: DataFrame,
    movies: DataFrame,
    day: str | None = None,
    media_type: str | None = "all",
    newest: Column | None = None,
) -> DataFrame:
    """Rows of a day with title and poster, by position."""
    wanted = parse_day(day)
    rows = on_latest(fact, newest=newest) if wanted is None else fact.filter(F.col("date") == F.lit(wanted))
    if media_type and media_type != "all":
        rows = rows.filter(F.col("media_type") == media_type)
    return with_movie(rows, movies).orderBy("position", "media_type", "movie_id")


def with_movie(rows: DataFrame, movies: DataFrame) -> DataFrame:
    names = movies.select("movie_id", F.col("title").alias("movie_title"), "poster_url")
    return rows.join(names, "movie_id")


def daily_api(fact: DataFrame, movies: DataFrame, day: str | None = None, media_type: str | None = None) -> DataFrame:
    """API rows; both filters are optional, and without them the whole fact is listed."""
    rows = of_period(fact, "date", day)
    if media_type:
        rows = rows.filter(F.col("media_type") == media_type)
    return with_movie(rows, movies).orderBy("position", "date", "media_type", "movie_id")


def weekly_api(weekly: DataFrame, movies: DataFrame, week: str | None = None) -> DataFrame:
    joined = with_movie(of_period(weekly, "week_start", week), movies).drop("poster_url")
    return joined.orderBy("avg_position", "week_start", "media_type", "movie_id")


def monthly_api(monthly: DataFrame, genres: DataFrame, month: str | None = None) -> DataFrame:
    named = of_period(monthly, "month", month).join(genres.select("genre_id", F.col("name").alias("genre_name")), "genre_id")
    return named.orderBy(F.col("trending_count").desc(), "month", "genre_id")


def listing(df: DataFrame, table: str) -> DataFrame:
    """A star-schema table in the order it is shown in."""
    return df.orderBy(*[F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in LISTING_ORDER[table]])


def page(ordered: DataFrame, number: int, rows: int = PAGE_ROWS) -> DataFrame:
    """A page of an ordered result, numbered from 1."""
    return ordered.offset((number - 1) * rows).limit(rows)


def page_after(df: DataFrame, table: str, last: dict[str, object], rows: int = PAGE_ROWS) -> DataFrame:
    """The page that follows the row with the given order values: no earlier page is read or carried along."""
    later, equal = F.lit(False), F.lit(True)
    for name, way in LISTING_ORDER[table]:
        value = F.lit(last[name])
        later = later | (equal & (F.col(name) < value if way == "desc" else F.col(name) > value))
        equal = equal & (F.col(name) == value)
    return page(listing(df.filter(later), table), 1, rows)


def kpis(fact: DataFrame, movies: DataFrame, genres: DataFrame, newest: Column | None = None) -> DataFrame:
    """One row: table sizes, latest day, rows and average score on it (0 without scores)."""
    newest = latest(fact) if newest is None else newest
    today = fact.filter(F.col("date") == newest).agg(
        F.count("*").alias("trending_today"),
        F.max("date").alias("_day"),
        F.coalesce(mean(F.sum(fixed("vote_average")), F.count(fixed("vote_average")), 1), F.lit(0.0)).alias("avg_rating"),
    )
    return today.select(
        movies.agg(F.count("*")).scalar().alias("total_movies"),
        genres.agg(F.count("*")).scalar().alias("total_genres"),
        F.coalesce(F.col("_day"), F.current_date()).alias("latest_date"),
        "trending_today",
        F.col("avg_rating").cast("double").alias("avg_rating"),
    )


def top_trending(
    fact: DataFrame, movies: DataFrame, media_type: str = "movie", n: int = 5, newest: Column | None = None
) -> DataFrame:
    rows = on_latest(fact, newest=newest).filter(F.col("media_type") == media_type)
    # The top n come first, so the join looks up n titles.
    return with_movie(rows.orderBy("position", "movie_id").limit(n), movies)


def genre_distribution(
    fact: DataFrame, bridge: DataFrame, genres: DataFrame, n: int = 10, newest: Column | None = None
) -> DataFrame:
    """Rows per genre on the latest day, the n largest; rows without a genre are not counted."""
    counted = genre_counts(on_latest(fact, newest=newest), bridge, genres)
    return counted.orderBy(F.col("rows").desc(), "genre_name").limit(n)


def genre_counts(rows: DataFrame, bridge: DataFrame, genres: DataFrame) -> DataFrame:
    per_title = rows.groupBy("movie_id").agg(F.count("*").alias("_rows"))
    per_genre = per_title.join(bridge, "movie_id").groupBy("genre_id").agg(F.sum("_rows").alias("rows"))
    named = per_genre.join(genres.select("genre_id", F.col("name").alias("genre_name")), "genre_id")
    return named.filter(F.col("genre_name").isNotNull()).select("genre_name", "rows")


def with_share(counted: DataFrame, total: DataFrame | None = None) -> DataFrame:
    """Each row's part of all rows, in percent: a scalar subquery, not a one-task window."""
    whole = (counted if total is None else total).agg(F.sum("rows")).scalar()
    return counted.withColumn("share_pct", percent("rows", whole, 2))


def popularity_timeline(
    fact: DataFrame,
    movies: DataFrame,
    media_type: str = "movie",
    n: int = 5,
    days: int = 7,
    newest: Column | None = None,
) -> DataFrame:
    """Series of the last days for the n leading titles: one semi-join instead of a query per title.

    A series has at most one point per media type and day of the week shown.
    """
    newest = latest(fact) if newest is None else newest
    leaders = fact.filter((F.col("date") == newest) & (F.col("media_type") == media_type))
    leaders = leaders.orderBy("position", "movie_id").limit(n).select("movie_id")
    recent = fact.filter(F.col("date") >= F.date_sub(newest, days - 1))
    points = recent.join(F.broadcast(leaders), "movie_id", "left_semi")
    series = points.groupBy("movie_id").agg(
        F.array_sort(F.collect_list(F.struct("date", "media_type", "popularity"))).alias("points")
    )
    named = series.join(movies.select("movie_id", "title"), "movie_id")
    return named.select(
        "movie_id",
        short_title("title", 25).alias("name"),
        F.col("points.date").alias("dates"),
        F.col("points.popularity").alias("values"),
    )


def title_timeline(fact: DataFrame, movie_id: int) -> DataFrame:
    """A title's whole history in order of days."""
    rows = fact.filter(F.col("movie_id") == movie_id)
    return rows.select("date", "media_type", "popularity", "position").orderBy("date", "media_type")


def weekly_leaders(weekly: DataFrame, movies: DataFrame, n: int = 20, newest: Column | None = None) -> DataFrame:
    rows = on_latest(weekly, "week_start", newest).orderBy("avg_position", "media_type", "movie_id").limit(n)
    return with_movie(rows, movies)


def weekly_positions_chart(leaders: DataFrame, n: int = 10) -> DataFrame:
    first = leaders.orderBy("avg_position", "media_type", "movie_id").limit(n)
    return first.select(
        "movie_id",
        "media_type",
        short_title("movie_title", 20).alias("movie"),
        F.col("avg_position").alias("position"),
        F.col("popularity_change_pct").alias("change"),
    )


def top_movers(
    weekly: DataFrame, movies: DataFrame, rising: bool = True, n: int = 5, newest: Column | None = None
) -> DataFrame:
    change = F.col("popularity_change_pct")
    rows = on_latest(weekly, "week_start", newest)
    first = rows.orderBy(change.desc() if rising else change.asc(), "media_type", "movie_id").limit(n)
    return with_movie(first, movies)


def newest_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n newest distinct days, weeks or months."""
    return df.select(column).distinct().orderBy(F.col(column).desc()).limit(n)


def monthly_report(monthly: DataFrame, genres: DataFrame, movies: DataFrame, newest: Column | None = None) -> DataFrame:
    """Genres of the latest month with their top title; a missing top title leaves the row."""
    rows = on_latest(monthly, "month", newest)
    named = rows.join(genres.select("genre_id", F.col("name").alias("genre_name")), "genre_id")
    leaders = movies.select(F.col("movie_id").alias("top_movie_id"), F.col("title").alias("top_title"))
    return named.join(leaders, "top_movie_id", "left").orderBy(F.col("trending_count").desc(), "genre_id")


def budget_scatter(movies: DataFrame, n: int = 50) -> DataFrame:
    """Budget against revenue in millions for n titles that have both."""
    priced = movies.filter((F.col("budget") > 0) & (F.col("revenue") > 0)).orderBy("movie_id").limit(n)
    return priced.select(
        "movie_id",
        short_title("title", 20).alias("title"),
        (F.col("budget") / 1e6).alias("budget_m"),
        (F.col("revenue") / 1e6).alias("revenue_m"),
        F.coalesce("roi", F.lit(0.0)).alias("roi"),
        bubble_size(F.coalesce("roi", F.lit(0.0))).alias("bubble"),
    )


def genre_bars(monthly: DataFrame, genres: DataFrame, n: int = 12, newest: Column | None = None) -> DataFrame:
    """Series of a bar chart: the first n genres of the latest month."""
    rows = on_latest(monthly, "month", newest)
    named = rows.join(genres.select("genre_id", F.col("name").alias("genre_name")), "genre_id")
    first = named.orderBy(F.col("trending_count").desc(), "genre_id").limit(n)
    return first.select("genre_name", "trending_count", "avg_popularity")


def movie_cast(cast: DataFrame, people: DataFrame, n: int = SHOWN_CAST, movie_id: int | None = None) -> DataFrame:
    """First n billed people of every title, or of one."""
    if movie_id is not None:
        cast = cast.filter(F.col("movie_id") == movie_id)
    billed = top_rows(cast, ["movie_id"], [F.col("cast_order"), F.col("person_id")], n)
    return billed.join(people.select("person_id", F.col("name").alias("person_name")), "person_id")


def filmography(cast: DataFrame, movies: DataFrame, person_id: int | None = None) -> DataFrame:
    """Every person's titles, or one person's, newest first."""
    if person_id is not None:
        cast = cast.filter(F.col("person_id") == person_id)
    titles = movies.select("movie_id", "title", "release_date")
    joined = cast.join(titles, "movie_id")
    return joined.orderBy("person_id", F.col("release_date").desc_nulls_last(), "movie_id")


def movies_with_genres(movies: DataFrame, bridge: DataFrame, genres: DataFrame) -> DataFrame:
    """Titles with their genres nested; a title has at most one entry per genre."""
    named = bridge.join(genres, "genre_id")
    nested = named.groupBy("movie_id").agg(F.array_sort(F.collect_set(F.struct("genre_id", "name"))).alias("genres"))
    empty = F.array().cast("array<struct<genre_id:int,name:string>>")
    return movies.join(nested, "movie_id", "left").withColumn("genres", F.coalesce("genres", empty))


def latest_score(fact: DataFrame) -> DataFrame:
    """Each title's score on its newest day."""
    return fact.groupBy("movie_id", "media_type").agg(F.max_by("vote_average", "date").alias("vote_average"))


def search(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-insensitive substring search."""
    return df.filter(F.lower(F.col(column)).contains(text.lower()))


def matching(df: DataFrame, **values: object) -> DataFrame:
    """Rows equal to every given value; None leaves a column free."""
    for name, value in values.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def between_days(fact: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """Rows from `start` on, up to but without `end`."""
    kept = fact.filter(F.col("date") >= start)
    return kept if end is None else kept.filter(F.col("date") < end)


def last_month(fact: DataFrame, today: Column) -> DataFrame:
    first = F.trunc(today, "MM")
    return between_days(fact, F.add_months(first, -1), first)


def last_week(fact: DataFrame, today: Column) -> DataFrame:
    return between_days(fact, F.date_sub(today, 7))


def titles_to_enrich(fact: DataFrame, movies: DataFrame, today: Column, n: int = ENRICH_TITLES) -> DataFrame:
    """Titles without a budget that trended within a week."""
    recent = last_week(fact, today).select("movie_id")
    unpriced = movies.filter(F.col("budget") == 0)
    return unpriced.join(recent, "movie_id", "left_semi").select("movie_id").orderBy("movie_id").limit(n)


def genre_movies(fact: DataFrame, bridge: DataFrame, genre_id: Column | int) -> DataFrame:
    """Fact rows of one genre's titles."""
    members = bridge.filter(F.col("genre_id") == genre_id).select("movie_id")
    return fact.join(members, "movie_id", "left_semi")
