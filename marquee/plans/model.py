"""The trend model derived from the supplied tables.

events are chart rows (user = title, event type = media type), parts are titles
whose name words are genres, line items give release dates and money, suppliers
are people.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions.exact import EXACT, fixed, mean, unfixed
from marquee.functions.labels import image_url
from marquee.operators.finance import roi_pct
from marquee.operators.trends import daily_positions

IMAGE_BASE = "https://images.example.org/t"


# Schemas by table path and time of its last change: a footer is read once, not once per query.
_SCHEMAS: dict[tuple[str, int], StructType] = {}


class Tables:
    """The supplied Parquet tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        changed = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(at).getModificationTime()
        if (path, changed) not in _SCHEMAS:
            _SCHEMAS[path, changed] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path, changed]).parquet(path)


def newest_day(t: Tables) -> Column:
    """Last chart day, from the one column that holds it rather than from the aggregated fact."""
    return t.events.agg(F.max("ts").cast("date")).scalar()


def events_between(t: Tables, first: Column | None, last: Column | None) -> DataFrame:
    """Events of the days from `first` to `last`, bounded on the stored column, so that the scan can skip the others."""
    rows = t.events
    if first is not None:
        rows = rows.filter(F.col("ts") >= first.cast("timestamp"))
    return rows if last is None else rows.filter(F.col("ts") < F.date_add(last, 1).cast("timestamp"))


def chart(t: Tables, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Daily fact: popularity sums the day's values, the score is their average."""
    values = events_between(t, first, last).select(
        F.col("user_id").alias("movie_id"),
        F.col("event_type").alias("media_type"),
        F.col("ts").cast("date").alias("date"),
        fixed("value").alias("_exact"),
    )
    return values.groupBy("movie_id", "media_type", "date").agg(
        unfixed(F.sum("_exact")).alias("popularity"),
        mean(F.sum("_exact"), F.count("_exact"), 6).alias("vote_average"),
        F.count("*").alias("vote_count"),
    )


def fact(t: Tables, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Chart with the day's position, ranked over all media types.

    A query about some days names them here: the others are then cut at the scan
    and not ranked at all.
    """
    return daily_positions(chart(t, first, last), "date")


def content(t: Tables) -> DataFrame:
    """Chart rows under the unified content columns, with title and genres."""
    titles = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.split("p_name", " ").alias("genres")
    )
    rows = chart(t).withColumnsRenamed({"movie_id": "id", "date": "extraction_date"})
    return rows.join(titles, "id", "left")


def genre_id(word: Column) -> Column:
    """Number built from the whole word."""
    digest = F.conv(F.substring(F.md5(word.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return digest.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def genre_words(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("movie_id"), F.explode(F.array_distinct(F.split("p_name", " "))).alias("genre_name")
    )


def genres(t: Tables) -> DataFrame:
    words = genre_words(t).select(F.col("genre_name").alias("name")).distinct()
    return words.select(genre_id(F.col("name")).alias("genre_id"), "name")


def bridge(t: Tables) -> DataFrame:
    return genre_words(t).select("movie_id", genre_id(F.col("genre_name")).alias("genre_id"))


def money(t: Tables) -> DataFrame:
    """Release date, budget and revenue in whole units per sold title.

    Line items are combined per title before the price is joined, so a title
    with most of the lines reaches the join as one row.
    """
    lines = t.lineitem.select(
        "l_partkey",
        F.col("l_shipdate").cast("date").alias("_shipped"),
        F.col("l_quantity").cast("bigint").alias("_pieces"),
        (fixed("l_extendedprice") * (1 - F.col("l_discount").try_cast("decimal(4,2)"))).cast(EXACT).alias("_income"),
    )
    sold = lines.groupBy("l_partkey").agg(
        F.min("_shipped").alias("release_date"), F.sum("_pieces").alias("_pieces"), F.sum("_income").alias("_income")
    )
    priced = sold.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return priced.select(
        F.col("l_partkey").alias("movie_id"),
        "release_date",
        F.floor(F.col("p_retailprice").try_cast("decimal(16,6)") * F.col("_pieces")).cast("bigint").alias("budget"),
        F.floor("_income").cast("bigint").alias("revenue"),
    )


def movies(t: Tables) -> DataFrame:
    """Title dimension; a title never sold has no release date and no money."""
    titles = t.part.select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.lower("p_type").alias("original_language"),
        F.col("p_brand").alias("overview"),
        F.col("p_size").alias("runtime"),
    )
    return titles.join(money(t), "movie_id", "left").select(
        "movie_id",
        "title",
        "original_language",
        "overview",
        "release_date",
        "runtime",
        F.coalesce("budget", F.lit(0).cast("bigint")).alias("budget"),
        F.coalesce("revenue", F.lit(0).cast("bigint")).alias("revenue"),
        roi_pct().alias("roi"),
        image_url(F.concat(F.lit("/"), F.col("movie_id").cast("string"), F.lit(".jpg")), IMAGE_BASE, "w500").alias(
            "poster_url"
        ),
    )


def titles(t: Tables) -> DataFrame:
    """Name and poster only, for queries that need no money."""
    poster = image_url(F.concat(F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".jpg")), IMAGE_BASE, "w500")
    return t.part.select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"), poster.alias("poster_url")
    )


def sales(t: Tables) -> DataFrame:
    """A longer daily fact: one row per line item shipped."""
    return t.lineitem.select(
        F.col("l_partkey").alias("movie_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("popularity"),
        F.col("l_quantity").alias("vote_average"),
    )


def cast(t: Tables) -> DataFrame:
    """Who appears in which title; the lowest line number is the billing."""
    return t.lineitem.groupBy(F.col("l_partkey").alias("movie_id"), F.col("l_suppkey").alias("person_id")).agg(
        F.min("l_linenumber").alias("cast_order")
    )


def people(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("popularity")
    )
