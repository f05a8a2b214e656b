"""Registered queries: parsing, cleaning, deduplication, labels and calendar keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.contracts import CREDITS_SCHEMA, GENRES, MOVIE, TV
from marquee.functions import calendar, labels, lenient
from marquee.functions.genres import genre_names
from marquee.operators import clean
from marquee.operators.keys import deduplicate
from marquee.plans import model
from marquee.plans.model import Tables
from marquee.plans.registry import CHART, MONEY, WORDS, query
from marquee.sources import landing

_NAMES = ", ".join(f"({key}, '{name}')" for key, name in GENRES.items())


def _raw_orders(t: Tables) -> DataFrame:
    """Orders as a raw feed: text columns, some of them malformed."""
    status = F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select(
        F.when(status == "P", None).otherwise(F.col("o_custkey")).alias("id"),
        F.when(status == "F", None).otherwise(F.col("o_orderpriority")).alias("title"),
        F.lit(None).cast("string").alias("overview"),
        F.lit("en").alias("original_language"),
        F.when(status == "O", "").otherwise(day).alias("release_date"),
        F.when(status == "F", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("popularity"),
        F.col("o_orderpriority").alias("vote_average"),
        F.substring("o_orderpriority", 1, 1).alias("vote_count"),
        F.col("o_custkey").cast("string").alias("budget"),
        F.col("o_orderkey").cast("string").alias("revenue"),
        F.col("o_orderkey").alias("_order"),
        F.col("o_orderdate").cast("date").alias("_extraction_date"),
        F.lit(None).cast("string").alias("poster_path"),
    )


_RAW = """
raw as (
  select case when o_orderstatus = 'P' then null else o_custkey end as id,
         case when o_orderstatus = 'F' then null else o_orderpriority end as title,
         case when o_orderstatus = 'O' then null else cast(o_orderdate as date) end as release_date,
         case when o_orderstatus = 'F' then null else o_totalprice end as popularity,
         cast(substr(o_orderpriority, 1, 1) as integer) as vote_count, o_custkey as budget, o_orderkey as revenue,
         o_orderkey as _order, cast(o_orderdate as date) as extraction_date
  from orders)"""


@query(
    "P1 P5 D10",
    f"""with {_RAW} select _order, release_date, popularity, cast(null as double) as vote_average, vote_count,
    extraction_date from raw""",
)
def typed_feed(t: Tables) -> DataFrame:
    typed = clean.cast_types(_raw_orders(t), MOVIE)
    return typed.select("_order", "release_date", "popularity", "vote_average", "vote_count", "extraction_date")


@query(
    "P2",
    f"""with {_RAW} select _order, coalesce(popularity, 0e0) as popularity, 0e0 as vote_average, vote_count,
    'No overview available' as overview, '' as poster_path from raw""",
)
def feed_with_defaults(t: Tables) -> DataFrame:
    filled = clean.fill_defaults(clean.cast_types(_raw_orders(t), MOVIE), MOVIE)
    return filled.select("_order", "popularity", "vote_average", "vote_count", "overview", "poster_path")


@query("P3", f"with {_RAW} select _order, id from raw where id is not null")
def rows_with_id(t: Tables) -> DataFrame:
    return clean.drop_null_ids(_raw_orders(t)).select("_order", "id")


@query(
    "P3 P4 P5 P6 W3 F11",
    f"""with {_RAW}, last_rows as (
      select *, row_number() over (partition by id order by _order desc) as place from raw where id is not null)
    select id, _order, release_date, coalesce(popularity, 0e0) as popularity, 0e0 as vote_average,
           cast(vote_count as bigint) as vote_count, budget, revenue,
           case when budget > 0 then cast(revenue - budget as double) / cast(budget as double) * 100 end as roi,
           coalesce(title, '') as title, '' as overview, 'en' as original_language
    from last_rows where place = 1""",
)
def cleaned_movies(t: Tables) -> DataFrame:
    return clean.clean_titles(_raw_orders(t), MOVIE, "_order").drop("_extraction_date", "poster_path")


@query(
    "P3 P4 P5 P6 W3",
    f"""with {_RAW}, last_rows as (
      select *, row_number() over (partition by id order by _order desc) as place from raw where id is not null)
    select id, _order, release_date as first_air_date, coalesce(popularity, 0e0) as popularity,
           0e0 as vote_average, cast(vote_count as bigint) as vote_count, coalesce(title, '') as name,
           '' as overview, 'en' as original_language from last_rows where place = 1""",
)
def cleaned_shows(t: Tables) -> DataFrame:
    feed = _raw_orders(t).drop("budget", "revenue")
    shows = feed.withColumnsRenamed({"title": "name", "release_date": "first_air_date"})
    return clean.clean_titles(shows, TV, "_order").drop("_extraction_date", "poster_path")


@query(
    "W1 D1",
    """select event_id, user_id, event_type, date from (
      select event_id, user_id, event_type, cast(ts as date) as date,
             row_number() over (partition by user_id, event_type, cast(ts as date) order by ts desc) as place
      from events) where place = 1""",
)
def latest_event_per_day(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("date"), "ts")
    return deduplicate(rows, ["user_id", "event_type", "date"], [F.col("ts")]).drop("ts")


@query(
    "W2",
    """select l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate from (
      select *, row_number() over (partition by l_partkey, l_suppkey
                                   order by l_shipdate, l_orderkey, l_linenumber, l_extendedprice) as place
      from lineitem) where place = 1""",
)
def first_sale_per_supplier(t: Tables) -> DataFrame:
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    rows = t.lineitem.select("l_partkey", "l_suppkey", *order)
    first = deduplicate(rows, ["l_partkey", "l_suppkey"], [F.col(c) for c in order], keep="first")
    return first.drop("l_extendedprice")


@query(
    "A1 F2 F3 J1",
    f"""with lookup(genre_id, genre_name) as (values {_NAMES}),
    ids as (select p_partkey, unnest([p_size, p_size * 2, p_size + 10700, 10800]) as genre_id from part)
    select p_partkey, coalesce(string_agg(distinct genre_name, ', ' order by genre_name), '') as genres
    from ids left join lookup using (genre_id) group by 1""",
)
def genre_name_arrays(t: Tables) -> DataFrame:
    """Ids of which some are unknown and some repeat."""
    size = F.col("p_size")
    ids = t.part.select("p_partkey", F.array(size, size * 2, size + 10700, F.lit(10800)).alias("genre_ids"))
    return ids.select("p_partkey", F.concat_ws(", ", genre_names("genre_ids")).alias("genres"))


@query(
    "F1 P10",
    f"with {WORDS} select movie_id, genre_name from words where genre_name is not null",
)
def exploded_genres(t: Tables) -> DataFrame:
    arrays = t.part.select(F.col("p_partkey").alias("movie_id"), F.array_distinct(F.split("p_name", " ")).alias("g"))
    return arrays.select("movie_id", F.explode_outer("g").alias("genre_name")).filter(F.col("genre_name").isNotNull())


def _feeds(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = model.content(t).select("id", "title", "popularity", "vote_average", "vote_count", "extraction_date",
                                   "media_type")
    movies = rows.filter(F.col("media_type") != "view").drop("media_type")
    shows = rows.filter(F.col("media_type") == "view").drop("media_type").withColumnRenamed("title", "name")
    return movies, shows


@query(
    "P7 U1",
    f"""with {CHART} select movie_id as id, p_name as title, popularity, vote_average, vote_count,
    date as extraction_date, case when media_type = 'view' then 'tv' else 'movie' end as media_type
    from scored left join part on p_partkey = movie_id""",
)
def unified_content(t: Tables) -> DataFrame:
    movies, shows = _feeds(t)
    return clean.unify(movies.withColumn("runtime", F.lit(90)), shows)


@query(
    "U2",
    """select c_custkey as id, c_name as title, cast(null as varchar) as name, cast(null as double) as popularity
    from customer union all select p_partkey, p_name, null, p_retailprice from part
    union all select s_suppkey, null, s_name, s_acctbal from supplier""",
)
def concatenated_feeds(t: Tables) -> DataFrame:
    return clean.concat_feeds(
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title")),
        t.part.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("popularity")
        ),
        t.supplier.select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("popularity")
        ),
    )


@query("U3", "select distinct user_id, cast(ts as date) as date from events")
def distinct_title_days(t: Tables) -> DataFrame:
    return t.events.select("user_id", F.col("ts").cast("date").alias("date")).distinct()


@query(
    "P16 S9",
    """with entries as (
      select p_partkey, unnest(string_split(p_name, ' ')) as title,
             unnest(range(1, len(string_split(p_name, ' ')) + 1)) as position
      from part)
    select p_partkey, title, cast(position as integer) as _position, 'movie' as _media_type,
           'trending_movies_day' as _source, '2026-06-29T08:00:00' as _extracted_at from entries""",
)
def positioned_entries(t: Tables) -> DataFrame:
    """A response per title: its name words as the listed results."""
    entries = F.transform(F.split("p_name", " "), lambda word: F.struct(word.alias("title")))
    responses = t.part.select("p_partkey", F.to_json(F.struct(entries.alias("results"))).alias("body"))
    placed = landing.positioned_results(
        responses, "body", MOVIE, "trending_movies_day", F.lit("2026-06-29T08:00:00")
    )
    return placed.drop("id", "name", "popularity")


@query(
    "F22 T4",
    """select p_partkey as movie_id, person_id, name, character_name, cast_order, known_for_department, popularity
    from (select p_partkey, unnest([
        {'person_id': cast(p_size as bigint), 'name': coalesce(p_name, ''), 'character_name': p_brand, 'cast_order': 0,
         'known_for_department': '', 'popularity': 0e0},
        {'person_id': cast(p_size + 100 as bigint), 'name': p_type, 'character_name': '', 'cast_order': 1,
         'known_for_department': 'Acting', 'popularity': p_retailprice}], max_depth := 2) from part)""",
)
def billed_cast(t: Tables) -> DataFrame:
    """Credits with three entries per title, of which the first two are kept."""
    size = F.col("p_size")
    people = F.array(
        F.struct(size.alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("character"),
                 F.lit(0).alias("order"), F.lit(None).cast("string").alias("known_for_department"),
                 F.lit(None).cast("double").alias("popularity")),
        F.struct((size + 100).alias("id"), F.col("p_type").alias("name"), F.lit(None).cast("string").alias("character"),
                 F.lit(1).alias("order"), F.lit("Acting").alias("known_for_department"),
                 F.col("p_retailprice").alias("popularity")),
        F.struct((size + 200).alias("id"), F.col("p_brand").alias("name"), F.col("p_type").alias("character"),
                 F.lit(2).alias("order"), F.lit("Directing").alias("known_for_department"),
                 F.lit(1.0).alias("popularity")),
    )
    body = F.to_json(F.struct(F.struct(people.alias("cast")).alias("credits")))
    details = t.part.select(F.col("p_partkey").alias("movie_id"), F.from_json(body, CREDITS_SCHEMA).alias("d"))
    return landing.billed_cast(details, F.col("d.credits"), 2)


@query(
    "S1",
    """select event_id, case when event_type = 'error' then null
                             else cast(json_extract_string(props, '$.k') as bigint) end as k,
    case when event_type = 'error' then 'x' || props end as _corrupt_record from events""",
)
def parsed_properties(t: Tables) -> DataFrame:
    """JSON text as fields; malformed records are kept aside, not lost."""
    body = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), F.col("props"))).otherwise(F.col("props"))
    rows = t.events.select("event_id", body.alias("body"))
    return landing.parse_lines(rows, "body", "k bigint").drop("body")


@query(
    "F4 F5 F6 F7 F8 F9",
    """select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
    strftime(o_orderdate, '%G-W%V') as year_week, strftime(o_orderdate, '%Y-%m') as year_month,
    cast(date_trunc('week', o_orderdate) as date) as week_start,
    cast(date_trunc('month', o_orderdate) as date) as month_start,
    cast(datediff('day', date '1970-01-01', cast(o_orderdate as date)) as integer) as epoch_day from orders""",
)
def calendar_keys(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return rows.select(
        "o_orderkey",
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        calendar.iso_week_label("day").alias("year_week"),
        calendar.month_label("day").alias("year_month"),
        calendar.week_start("day").alias("week_start"),
        calendar.month_start("day").alias("month_start"),
        calendar.epoch_day("day").alias("epoch_day"),
    )


_MONEY_LABEL = """case when v >= 1e9 then '$' || format('{:.1f}B', v / 1e9)
         when v >= 1e6 then '$' || format('{:.0f}M', v / 1e6)
         when v > 0 then '$' || format('{:,}', cast(v as bigint)) else 'N/A' end"""


@query(
    "F17 F18",
    f"""with {MONEY}, amounts as (
      select movie_id, cast(revenue as double) as v from movies union all
      select movie_id, cast(revenue * 300 as double) from movies union all
      select movie_id, cast(revenue - revenue as double) from movies)
    select movie_id, v, {_MONEY_LABEL} as label,
           case when v >= 1e6 then '$' || format('{{:.0f}}M', v / 1e6)
                when v > 0 then '$' || format('{{:,}}', cast(v as bigint)) else 'N/A' end as short_label,
           format('{{:,}}', cast(v as bigint)) as thousands, cast(abs(v) as bigint) as size
    from amounts""",
)
def amount_labels(t: Tables) -> DataFrame:
    revenue = F.col("revenue")
    amounts = model.movies(t).select(
        "movie_id", F.explode(F.array(revenue, revenue * 300, revenue * 0).cast("array<double>")).alias("v")
    )
    return amounts.select(
        "movie_id",
        "v",
        labels.money_label("v").alias("label"),
        labels.money_label("v", billions=False).alias("short_label"),
        labels.thousands_label("v").alias("thousands"),
        labels.magnitude("v").alias("size"),
    )


@query(
    "F16 F18",
    """with changes as (select event_id, cast(value as bigint) - 20 as change from (
      select event_id, floor(value) as value from events))
    select event_id, change, case when change > 0 then '↑' when change < 0 then '↓' else '→' end as arrow,
    case when change > 0 then 'trend-up' when change < 0 then 'trend-down' else 'trend-neutral' end as css,
    abs(change) as size from changes""",
)
def direction_labels(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", (F.floor("value") - 20).alias("change"))
    return rows.withColumns(
        {
            "arrow": labels.trend_arrow("change"),
            "css": labels.trend_class("change"),
            "size": labels.magnitude("change"),
        }
    )


@query(
    "F19",
    """with scores as (select l_orderkey, l_linenumber, l_partkey, l_quantity / 5 as score from lineitem),
    halves as (select *, cast(floor(score / 2) as integer) as whole, score / 2 - floor(score / 2) >= 0.5 as half
      from scores)
    select l_orderkey, l_linenumber, l_partkey, score,
           repeat('★', whole) || case when half then '½' else '' end
           || repeat('☆', 5 - whole - cast(half as integer)) as stars from halves""",
)
def star_labels(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") / 5).alias("score"))
    return rows.withColumn("stars", labels.star_rating("score"))


@query(
    "F15 F21 F23",
    """select page_id,
    case when url like 'https%' then '' else 'https://images.example.org/t/w500/' || page_id end as poster_url,
    substr(html, 1, 25) as short_title, coalesce(case when url like '%#top' then null else url end, html) as title,
    case when url like '%/en/%' then null else url end as released from pages""",
)
def text_labels(t: Tables) -> DataFrame:
    url = F.col("url")
    path = F.when(url.startswith("https"), "").otherwise(F.concat(F.lit("/"), F.col("page_id").cast("string")))
    rows = t.pages.select(
        "page_id",
        path.alias("path"),
        "html",
        F.when(url.endswith("#top"), None).otherwise(url).alias("first_name"),
        F.when(url.contains("/en/"), "").otherwise(url).alias("day"),
    )
    return rows.select(
        "page_id",
        labels.image_url("path", model.IMAGE_BASE, "w500").alias("poster_url"),
        labels.short_title("html", 25).alias("short_title"),
        lenient.first_text("first_name", "html").alias("title"),
        lenient.blank_to_null("day").alias("released"),
    )
