"""Casting, defaults, alignment and union of the content feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.contracts import FEEDS, MOVIE, NO_OVERVIEW, PERSON, TV, UNIFIED_COLUMNS
from marquee.functions.genres import empty_names, genre_names
from marquee.functions.lenient import lenient_date, lenient_number, number_or_zero, text_or_empty
from marquee.operators.finance import roi_pct
from marquee.operators.keys import deduplicate

NUMBERS = {
    "popularity": "double",
    "vote_average": "double",
    "vote_count": "int",
    "budget": "double",
    "revenue": "double",
}
DAYS = {MOVIE: "release_date", TV: "first_air_date"}


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def cast_types(df: DataFrame, media: str) -> DataFrame:
    """Typed columns of a feed; what does not parse becomes null."""
    numbers = ["popularity"] if media == PERSON else list(NUMBERS)
    typed = {name: lenient_number(name, NUMBERS[name]) for name in _present(df, numbers)}
    if media in DAYS and DAYS[media] in df.columns:
        typed[DAYS[media]] = lenient_date(DAYS[media])
    if "_extraction_date" in df.columns:
        typed["extraction_date"] = F.col("_extraction_date")
    return df.withColumns(typed)


def add_genres(df: DataFrame) -> DataFrame:
    """Names for `genre_ids`, or an empty array where the feed has no genres."""
    return df.withColumn("genres", genre_names("genre_ids") if "genre_ids" in df.columns else empty_names())


def fill_defaults(df: DataFrame, media: str) -> DataFrame:
    """Defaults for missing values; only popularity is filled for people."""
    defaults = {"popularity": F.lit(0.0)}
    if media != PERSON:
        defaults |= {
            "overview": F.lit(NO_OVERVIEW),
            "vote_average": F.lit(0.0),
            "vote_count": F.lit(0),
            "poster_path": F.lit(""),
        }
    defaults["genres"] = empty_names()
    return df.withColumns({name: F.coalesce(F.col(name), defaults[name]) for name in _present(df, list(defaults))})


def align_show(df: DataFrame) -> DataFrame:
    """TV columns under the names the movies use."""
    return df.withColumnsRenamed({"name": "title", "first_air_date": "release_date"}).withColumn("media_type", F.lit(TV))


def align_movie(df: DataFrame) -> DataFrame:
    return df.withColumn("media_type", F.lit(MOVIE))


def unify(movies: DataFrame, shows: DataFrame) -> DataFrame:
    """Movies and shows on the columns both have."""
    feeds = [align_movie(movies), align_show(shows)]
    common = set(UNIFIED_COLUMNS).intersection(*(feed.columns for feed in feeds))
    columns = sorted(common, key=UNIFIED_COLUMNS.index)
    return reduce(DataFrame.unionByName, [feed.select(columns) for feed in feeds])


def concat_feeds(*feeds: DataFrame) -> DataFrame:
    """All feeds in one table; a column a feed lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def drop_null_ids(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["id"])


def clean_titles(df: DataFrame, media: str, order_by: str) -> DataFrame:
    """Whole-table cleaning of a title feed: parse, fill, price, keep the last row per id."""
    kept = drop_null_ids(df)
    whole = {"vote_count": "bigint", "budget": "bigint", "revenue": "bigint"}
    names = ["popularity", "vote_average", "vote_count"] + (["budget", "revenue"] if media == MOVIE else [])
    columns = {"id": F.col("id").cast("bigint")}
    columns |= {name: number_or_zero(name, whole.get(name, "double")) for name in _present(kept, names)}
    texts = ["title" if media == MOVIE else "name", "overview", "original_language"]
    columns |= {name: text_or_empty(name) for name in _present(kept, texts)}
    if DAYS[media] in kept.columns:
        columns[DAYS[media]] = lenient_date(DAYS[media])
    typed = kept.withColumns(columns)
    if media == MOVIE and {"budget", "revenue"} <= set(typed.columns):
        typed = typed.withColumn("roi", roi_pct(digits=None))
    return deduplicate(typed, ["id"], [F.col(order_by)])


def silver(df: DataFrame, feed: str) -> DataFrame:
    """Bronze to silver: latest row per title and day, typed, with genres and defaults."""
    media = FEEDS[feed]
    latest = deduplicate(df, ["id", "_extraction_date"], [F.col("_ingested_at")])
    typed = cast_types(latest, media)
    if media != PERSON:
        typed = add_genres(typed)
    return typed
