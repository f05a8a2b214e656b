"""Registered queries: quality gates, merges, and tables written and read back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.contracts import STAR_KEYS
from marquee.operators import integrity, merge, quality, rollups, trends
from marquee.plans import jobs, model
from marquee.plans.model import Tables
from marquee.plans.registry import CAST, CHART, CONTENT, MONEY, WORDS, query
from marquee.plans.trend_queries import MONTHLY, WEEKLY_CHANGE
from marquee.session import fresh_path
from marquee.sources import commits, export, landing, layers
from marquee.sources.warehouse import Warehouse
from marquee.streaming import bronze

_FACT_KEY = ["movie_id", "date", "media_type"]


# --- quality gates ---


def _content_rows(t: Tables) -> DataFrame:
    return model.content(t).withColumn("id", F.when(F.col("media_type") != "error", F.col("id")))


@query(
    "A13 Q3 Q4",
    f"""with {CHART} select count(*) as records, count(*) filter (media_type = 'error') as null_ids,
    count(*) filter (vote_average < 0 or vote_average > 10) as scores_out_of_range,
    count(*) filter (popularity < 0) as negative_popularity from scored""",
)
def violation_counts(t: Tables) -> DataFrame:
    return quality.violations(_content_rows(t))


@query(
    "A14",
    """select count(*) filter (l_quantity < 2) as l_quantity_below_min,
    count(*) filter (l_quantity > 49) as l_quantity_above_max,
    count(*) filter (l_discount > 0.05) as l_discount_above_max from lineitem""",
)
def rule_counts(t: Tables) -> DataFrame:
    checks = {"l_quantity": {"min": 2, "max": 49}, "l_discount": {"max": 0.05}, "not_there": {"min": 0}}
    return quality.rule_counts(t.lineitem, checks)


@query(
    "F14 Q4",
    f"""with {CHART} select movie_id, media_type, date,
    case when media_type = 'view' then null else vote_average >= 0 and vote_average <= 10 end
    as _dq_vote_avg_valid from scored""",
)
def flagged_scores(t: Tables) -> DataFrame:
    rows = model.chart(t).withColumn("vote_average", F.when(F.col("media_type") != "view", F.col("vote_average")))
    return quality.flag_scores(rows).select("movie_id", "media_type", "date", "_dq_vote_avg_valid")


@query(
    "Q2",
    """select count(*) as records, count(*) filter (event_type = 'error') as missing_id,
    0::bigint as missing__source, count(*) filter (value is null or value > 100) as missing__extracted_at from events""",
)
def missing_fields(t: Tables) -> DataFrame:
    records = t.events.select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"),
        F.lit("trending_movies_day").alias("_source"),
        F.when(F.col("value") <= 100, F.col("ts")).alias("_extracted_at"),
    )
    return quality.missing_fields(records, ["id", "_source", "_extracted_at"])


@query(
    "J15",
    "select doc_id, n_chars from documents where doc_id not in (select doc_id from labels)",
)
def orphan_documents(t: Tables) -> DataFrame:
    """Rows whose key has no parent row."""
    return quality.orphans(t.documents.select("doc_id", "n_chars"), "doc_id", t.labels, "doc_id")


@query(
    "J15",
    "select count(*) as orphans from lineitem where l_partkey not in (select p_partkey from part)",
)
def orphan_count(t: Tables) -> DataFrame:
    return quality.orphan_count(t.lineitem, "l_partkey", t.part, "p_partkey")


@query(
    "M1 D16",
    """select l_partkey, l_suppkey, count(*) as copies from lineitem group by 1, 2 having count(*) > 1""",
)
def repeated_keys(t: Tables) -> DataFrame:
    return quality.repeated_keys(t.lineitem, ["l_partkey", "l_suppkey"])


@query(
    "Q5 A8",
    f"""with {CHART}, {WORDS} select (select count(*) from chart where date = (select max(date) from chart)) as facts,
    (select count(*) from part) as movies, (select count(*) from genres) as genres""",
)
def load_counts(t: Tables) -> DataFrame:
    return quality.load_counts(model.chart(t), t.part, model.genres(t), model.newest_day(t))


# --- integrity: facts against the titles of a part of the dimension; some lack a required or an optional value ---


def _incoming(t: Tables) -> DataFrame:
    rows = model.chart(t).select("movie_id", "media_type", "date", "popularity")
    position = F.when(F.dayofmonth("date") != 9, F.dayofmonth("date"))
    return rows.withColumns({"position": position, "popularity": F.when(F.col("media_type") != "view", F.col("popularity"))})


def _some_titles(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_size") > 10).select(F.col("p_partkey").alias("movie_id"))


_INCOMING = f"""{CHART},
incoming as (
  select movie_id, media_type, date, case when media_type <> 'view' then popularity end as popularity,
         case when day(date) <> 9 then day(date) end as position,
         exists (select 1 from part where p_partkey = movie_id and p_size > 10) as known
  from scored)"""


@query(
    "J15 Q1",
    f"""with {_INCOMING} select movie_id, media_type, date, coalesce(popularity, 0e0) as popularity,
    cast(position as integer) as position, 0 as position_change from incoming where known and position is not null""",
)
def accepted_facts(t: Tables) -> DataFrame:
    good, _ = integrity.screened(_incoming(t), "fact_daily_trends", {"dim_movies": _some_titles(t)})
    return good.select("movie_id", "media_type", "date", "popularity", "position", "position_change")


@query(
    "J15 Q1",
    f"""with {_INCOMING} select movie_id, media_type, date,
    concat_ws(', ', case when position is null then 'no position' end, case when not known then 'unknown movie_id' end)
    as violation from incoming where not known or position is null""",
)
def rejected_facts(t: Tables) -> DataFrame:
    _, bad = integrity.screened(_incoming(t), "fact_daily_trends", {"dim_movies": _some_titles(t)})
    return bad.select("movie_id", "media_type", "date", "violation")


# --- merges: the first 20 days are loaded, a batch re-sends from day 18 on with doubled popularity ---


def _loaded(t: Tables) -> DataFrame:
    rows = model.chart(t).select("movie_id", "media_type", "date", "popularity", "vote_count")
    return rows.filter(F.col("date") <= F.lit("2024-01-20").cast("date"))


def _batch(t: Tables) -> DataFrame:
    rows = model.chart(t).select("movie_id", "media_type", "date", "popularity", "vote_count")
    late = rows.filter(F.col("date") >= F.lit("2024-01-18").cast("date"))
    return late.withColumn("popularity", F.col("popularity") * 2)


_MERGE = f"""{CHART},
loaded as (
  select movie_id, media_type, date, popularity, vote_count from scored where date <= date '2024-01-20'),
batch as (
  select movie_id, media_type, date, popularity * 2 as popularity, vote_count from scored
  where date >= date '2024-01-18')"""


@query(
    "M1 M5",
    f"""with {_MERGE} select * from loaded anti join batch using (movie_id, media_type, date)
    union all select * from batch""",
)
def upserted_facts(t: Tables) -> DataFrame:
    return merge.upsert(_loaded(t), _batch(t), _FACT_KEY)


@query(
    "M1 M2",
    f"""with {_MERGE} select movie_id, media_type, date, coalesce(b.popularity, l.popularity) as popularity,
    coalesce(l.vote_count, b.vote_count) as vote_count
    from loaded l full join (select movie_id, media_type, date, popularity, vote_count + 1000 as vote_count from batch) b
    using (movie_id, media_type, date)""",
)
def upserted_facts_keeping_votes(t: Tables) -> DataFrame:
    batch = _batch(t).withColumn("vote_count", F.col("vote_count") + 1000)
    return merge.upsert(_loaded(t), batch, _FACT_KEY, keep=["vote_count"])


@query(
    "M2",
    f"""with {MONEY} select movie_id, original_language,
    case when release_date >= date '1995-01-15' then upper(title) else title end as title,
    case when release_date >= date '1995-01-15' then revenue + 1 else revenue end as revenue,
    case when release_date >= date '1995-01-15' then timestamp '2026-06-29 08:00:00' end as updated_at from movies""",
)
def upserted_movies(t: Tables) -> DataFrame:
    """Re-sent titles change all but their language and carry the time of the merge; other buckets stay as they are."""
    movies = model.movies(t).select("movie_id", "original_language", "title", "revenue", "release_date")
    sent = movies.filter(F.col("release_date") >= F.lit("1995-01-15").cast("date")).drop("release_date")
    sent = sent.withColumns(
        {"title": F.upper("title"), "revenue": F.col("revenue") + 1, "original_language": F.lit("changed")}
    )
    stamp = {"updated_at": F.lit("2026-06-29 08:00:00").cast("timestamp")}
    merged = _merged_twice(t, "dim_movies", movies.drop("release_date"), sent, ["original_language"], stamp)
    columns = ["movie_id", "original_language", "title", "revenue"]
    return merged.select(*columns, F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


def _merged_twice(t: Tables, name: str, known: DataFrame, sent: DataFrame, keep: list[str], stamp: dict | None = None) -> DataFrame:
    """A dimension of the warehouse after a first load and a batch."""
    warehouse, key = Warehouse(t.spark, fresh_path(t.spark, "warehouse"), {name: 4}), STAR_KEYS[name]
    # Some titles have no name, which a checked merge would refuse.
    warehouse.merge(name, known, lambda old, new: merge.upsert(old, new, key))
    warehouse.merge(name, sent, lambda old, new: merge.upsert(old, new, key, keep, stamp))
    return warehouse.read(name)


@query(
    "M3",
    f"""with {WORDS} select genre_id, case when name < 'h' then upper(name) else name end as name from genres""",
)
def upserted_genres(t: Tables) -> DataFrame:
    genres = model.genres(t)
    sent = genres.filter(F.col("name") < "h").withColumn("name", F.upper("name"))
    return _merged_twice(t, "dim_genres", genres, sent, [])


@query(
    "M4",
    """select s_suppkey as person_id, case when s_acctbal > 5000 then upper(s_name) else s_name end as name,
    case when s_acctbal > 8000 then 'Directing' else 'Acting' end as known_for_department,
    case when s_acctbal > 5000 then s_acctbal * 2 else s_acctbal end as popularity from supplier""",
)
def upserted_people(t: Tables) -> DataFrame:
    """An update leaves the department, an insert brings its own; the most popular people are new."""
    people = model.people(t).withColumn("known_for_department", F.lit("Acting"))
    known = people.filter(F.col("popularity") <= 8000)
    sent = people.filter(F.col("popularity") > 5000).withColumns(
        {
            "name": F.upper("name"),
            "popularity": F.col("popularity") * 2,
            "known_for_department": F.lit("Directing"),
        }
    )
    merged = _merged_twice(t, "dim_people", known, sent, ["known_for_department"])
    return merged.select("person_id", "name", "known_for_department", "popularity")


@query(
    "M6",
    f"""with {WEEKLY_CHANGE} select movie_id, media_type, week_start,
    case when week_start >= date '2024-01-15' then -1 else days_trending end as days_trending from changed""",
)
def replaced_weeks(t: Tables) -> DataFrame:
    weekly = rollups.weekly_summary(model.fact(t)).select("movie_id", "media_type", "week_start", "days_trending")
    batch = weekly.filter(F.col("week_start") >= F.lit("2024-01-15").cast("date"))
    batch = batch.withColumn("days_trending", F.lit(-1).cast("bigint"))
    return merge.replace_by_key(weekly, batch, ["movie_id", "media_type", "week_start"])


@query(
    "M7",
    f"""with {MONTHLY} select month, genre_id,
    case when month >= date '1999-01-01' then 0 else trending_count end as trending_count from monthly_genres""",
)
def replaced_months(t: Tables) -> DataFrame:
    monthly = rollups.monthly_genres(model.sales(t), model.bridge(t)).select("month", "genre_id", "trending_count")
    batch = monthly.filter(F.col("month") >= F.lit("1999-01-01").cast("date"))
    batch = batch.withColumn("trending_count", F.lit(0).cast("bigint"))
    return merge.replace_by_key(monthly, batch, ["month", "genre_id"])


@query(
    "M8 M9",
    f"with {WORDS} select movie_id, genre_id from bridge",
)
def linked_genres(t: Tables) -> DataFrame:
    """Links of cheap titles exist; all links are sent, twice."""
    links = model.bridge(t)
    cheap = t.part.filter(F.col("p_retailprice") < 950).select(F.col("p_partkey").alias("movie_id"))
    present = links.join(cheap, "movie_id", "left_semi")
    return merge.insert_absent(present, links.unionByName(links), ["movie_id", "genre_id"])


@query(
    "M8 M9",
    f"""with {CAST} select movie_id, person_id, case when cast_order = 1 then 1 else cast_order + 100 end as cast_order
    from cast_links""",
)
def linked_cast(t: Tables) -> DataFrame:
    """An existing link keeps its billing, whatever is sent."""
    links = model.cast(t)
    present = links.filter(F.col("cast_order") == 1)
    sent = links.withColumn("cast_order", F.col("cast_order") + 100)
    return merge.insert_absent(present, sent, ["movie_id", "person_id"])


@query(
    "M11",
    f"""with {CAST} select movie_id, person_id, cast_order from cast_links
    where person_id not in (select s_suppkey from supplier where s_acctbal < 0)""",
)
def links_after_delete(t: Tables) -> DataFrame:
    gone = t.supplier.filter(F.col("s_acctbal") < 0)
    return merge.delete_cascade(model.cast(t), "person_id", gone, "s_suppkey")


@query(
    "M11",
    """select o_orderkey, case when c_mktsegment = 'BUILDING' then null else o_custkey end as o_custkey
    from orders left join customer on c_custkey = o_custkey""",
)
def references_after_delete(t: Tables) -> DataFrame:
    gone = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return merge.set_null(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", gone, "c_custkey")


# --- the star schema as a whole: loads that are refused, links that are appended, deletes that carry references ---


def _star(t: Tables) -> Warehouse:
    """Titles, genres and the links of titles whose price is even, loaded by the jobs."""
    warehouse = Warehouse(t.spark, fresh_path(t.spark, "warehouse"), {n: 4 for n in ("dim_movies", "bridge_movie_genres")})
    jobs.upsert_movies(warehouse, model.titles(t).withColumn("title", F.coalesce("title", F.lit(""))))
    jobs.upsert_genres(warehouse, model.genres(t))
    jobs.link(warehouse, "bridge_movie_genres", model.bridge(t).filter(F.col("movie_id") % 2 == 0))
    return warehouse


def _charted_titles(t: Tables) -> DataFrame:
    """Facts of the chart's titles that the dimension has."""
    known = t.part.select(F.col("p_partkey").alias("movie_id"))
    return _facts(t).join(known, "movie_id", "left_semi")


def _facts(t: Tables) -> DataFrame:
    rows = model.chart(t).withColumns({"position": F.dayofmonth("date"), "position_change": F.lit(0)})
    return rows.withColumn("vote_count", F.col("vote_count").cast("int"))


@query("M8 M9", f"with {WORDS} select movie_id, genre_id from bridge")
def appended_links(t: Tables) -> DataFrame:
    """Half of the links exist; all are sent, twice, and only the other half is written."""
    warehouse = _star(t)
    for _ in range(2):
        jobs.link(warehouse, "bridge_movie_genres", model.bridge(t))
    return warehouse.read("bridge_movie_genres")


@query(
    "J15 Q1 M5",
    f"""with {CHART} select date, count(*) as facts, 'unknown movie_id' as refused
    from chart where movie_id in (select p_partkey from part) group by date""",
)
def refused_load(t: Tables) -> DataFrame:
    """Facts of known titles are loaded; a batch that re-sends them with one title that nobody knows changes nothing."""
    warehouse, facts = _star(t), _charted_titles(t)
    jobs.upsert_facts(warehouse, facts)
    unknown = F.when(F.col("movie_id") == facts.agg(F.min("movie_id")).scalar(), -1).otherwise(F.col("movie_id"))
    try:
        jobs.upsert_facts(warehouse, facts.withColumns({"movie_id": unknown, "popularity": F.lit(0.0)}))
        refused = ""
    except quality.QualityError as problem:
        refused = str(problem).split(": ")[1].split(",")[0]
    loaded = warehouse.read("fact_daily_trends")
    return loaded.groupBy("date").agg(F.count("*").alias("facts")).withColumn("refused", F.lit(refused))


@query(
    "M11 J15",
    f"""with {CHART}, {WORDS}, stays as (select p_partkey as movie_id from part where coalesce(p_size <= 40, true)),
    top as (select genre_id, max(movie_id) as movie_id from bridge group by 1)
    select 'dim_movies' as "table", count(*) as "rows", 0 as emptied from stays
    union all select 'bridge_movie_genres', count(*), 0 from bridge semi join stays using (movie_id) where movie_id % 2 = 0
    union all select 'fact_daily_trends', count(*), 0 from chart semi join stays using (movie_id)
    union all select 'agg_monthly_genres', count(*), cast(count(*) filter (movie_id not in (select movie_id from stays)) as integer) from top""",
)
def star_after_delete(t: Tables) -> DataFrame:
    """Large titles are withdrawn: their links and facts go, months they led lose their leader and stay."""
    warehouse = _star(t)
    jobs.upsert_facts(warehouse, _charted_titles(t))
    leaders = model.bridge(t).groupBy("genre_id").agg(F.max("movie_id").alias("top_movie_id"))
    leaders = leaders.withColumn("month", F.lit("2024-01-01").cast("date"))
    key = STAR_KEYS["agg_monthly_genres"]
    warehouse.merge_checked("agg_monthly_genres", leaders, lambda old, new: merge.replace_by_key(old, new, key))
    jobs.retire(warehouse, "dim_movies", t.part.filter(F.col("p_size") > 40).select(F.col("p_partkey").alias("movie_id")))
    counts = []
    for name in ("dim_movies", "bridge_movie_genres", "fact_daily_trends", "agg_monthly_genres"):
        table = warehouse.read(name)
        emptied = F.count_if(F.col("top_movie_id").isNull()) if "top_movie_id" in table.columns else F.lit(0).cast("bigint")
        counts.append(table.agg(F.lit(name).alias("table"), F.count("*").alias("rows"), emptied.cast("int").alias("emptied")))
    return reduce(DataFrame.unionByName, counts)


# --- tables written to the shared folder and read back ---

_FEED = "trending_movies"
_RAW_COLUMNS = """movie_id as id, p_name as title, popularity, vote_average, cast(vote_count as integer) as vote_count"""


def _landed(t: Tables, base: str) -> None:
    """The whole chart as landed JSON, one folder per day."""
    raw = model.content(t).select(
        "id",
        "title",
        F.col("popularity").cast("string").alias("popularity"),
        F.col("vote_average").cast("string").alias("vote_average"),
        F.col("vote_count").cast("string").alias("vote_count"),
        F.lit("2010-07-16").alias("release_date"),
        F.array(F.lit(28), F.lit(878)).alias("genre_ids"),
        F.col("extraction_date").alias("date"),
    )
    landing.write_landing(raw, base, _FEED)


def _charted(columns: str, where: str = "true") -> str:
    return f"with {CHART} select {columns} from scored left join part on p_partkey = movie_id where {where}"


@query(
    "S1 S2 S8",
    _charted(
        f"{_RAW_COLUMNS}, 'trending_movies' as _media_type, 'feed' as _source, 'b1' as _batch_id",
        "date = date '2024-01-15'",
    ),
)
def landed_day(t: Tables) -> DataFrame:
    """JSON of one day read under the fixed schema, with lineage."""
    base = fresh_path(t.spark, "landing")
    _landed(t, base)
    raw = landing.read_raw(t.spark, base, _FEED, "2024-01-15")
    traced = landing.with_lineage(raw, _FEED, "2024-01-15", "b1", "feed")
    return traced.select(
        "id",
        "title",
        F.col("popularity").cast("double").alias("popularity"),
        F.col("vote_average").cast("double").alias("vote_average"),
        F.col("vote_count").cast("int").alias("vote_count"),
        "_media_type",
        "_source",
        "_batch_id",
    )


@query(
    "Q1 S1",
    f"""with {CONTENT}, landed as (select * from content where extraction_date = date '2024-01-15')
    select field, records from (
      select 'id' as field, count(id) as records from landed union all select 'title', count(title) from landed
      union all select 'popularity', count(popularity) from landed union all select 'vote_average', count(vote_average) from landed
      union all select 'vote_count', count(*) from landed union all select 'release_date', count(*) from landed
      union all select 'genre_ids', count(*) from landed) where records > 0""",
)
def field_census(t: Tables) -> DataFrame:
    """Records of a landed day by the fields they name; a writer leaves out what is null."""
    base = fresh_path(t.spark, "landing")
    _landed(t, base)
    return landing.field_census(t.spark, base, _FEED, "2024-01-15")


@query(
    "S1 S2 S4 S8",
    _charted("""movie_id as id, p_name as title, date as _extraction_date, cast(year(date) as integer) as year,
    cast(month(date) as integer) as month, 'feed' as _source"""),
)
def bronze_from_stream(t: Tables) -> DataFrame:
    """All landed days picked up once by a file stream; a second run finds nothing new."""
    base = fresh_path(t.spark, "bronze")
    _landed(t, base)
    for _ in range(2):
        bronze.ingest_available(t.spark, base, _FEED, "feed", f"{base}/bronze/{_FEED}", f"{base}/progress")
    table = layers.read_layer(t.spark, f"{base}/bronze/{_FEED}")
    return table.select("id", "title", "_extraction_date", "year", "month", "_source")


@query(
    "S4 S5",
    _charted("movie_id as id, popularity, cast(year(date) as integer) as year, cast(month(date) as integer) as month"),
)
def bronze_appended(t: Tables) -> DataFrame:
    """Two appends, one per half of the month, into month partitions."""
    path = fresh_path(t.spark, "bronze")
    rows = model.content(t).select("id", "popularity", F.col("extraction_date").alias("_extraction_date"))
    half = F.lit("2024-01-15").cast("date")
    layers.append_bronze(rows.filter(F.col("_extraction_date") < half), path)
    layers.append_bronze(rows.filter(F.col("_extraction_date") >= half), path)
    return layers.read_layer(t.spark, path).drop("_extraction_date")


@query(
    "S6 D1",
    f"""with {_MERGE} select movie_id, media_type, date as extraction_date, popularity, vote_count from loaded
    where date < date '2024-01-18' union all select movie_id, media_type, date, popularity, vote_count from batch""",
)
def silver_days_replaced(t: Tables) -> DataFrame:
    """A later batch replaces the days it holds and leaves the others."""
    path = fresh_path(t.spark, "silver")
    for rows in (_loaded(t), _batch(t)):
        layers.overwrite_silver_days(rows.withColumnRenamed("date", "extraction_date"), path)
    return layers.read_layer(t.spark, path)


@query(
    "S7 S14 S15",
    f"""with {CONTENT}, ranked as (
      select *, dense_rank() over (partition by extraction_date order by units desc) as position from content),
    lagged as (
      select *, lag(position) over h as prev_position, lag(popularity) over h as prev_popularity,
             count(*) over (h rows between unbounded preceding and current row) as days_on_chart
      from ranked window h as (partition by media_type, id order by extraction_date))
    select id, title, media_type, popularity, vote_average, vote_count, position, prev_position,
           prev_position - position as position_change, popularity - prev_popularity as popularity_delta,
           prev_position is null as is_new_entry, days_on_chart, extraction_date from lagged""",
)
def gold_exported(t: Tables) -> DataFrame:
    """The daily mart written as a whole, twice, and shaped for export."""
    path = fresh_path(t.spark, "gold")
    for _ in range(2):
        layers.overwrite_gold(trends.daily_trends(model.content(t)), path, "gold_daily_trends")
    return export.export_projection(layers.read_layer(t.spark, path), "gold_daily_trends")


@query("S14", "select p_partkey, coalesce(array_to_string(string_split(p_name, ' '), ', '), '') as genres from part")
def arrays_as_text(t: Tables) -> DataFrame:
    return export.arrays_as_text(t.part.select("p_partkey", F.split("p_name", " ").alias("genres")))


@query("S9", "select user_id, event_type, value from events")
def snapshot_read_back(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "snapshot")
    landing.write_snapshot(t.events.select("user_id", "event_type", "value"), path)
    return landing.read_snapshot(t.spark, path, "user_id bigint, event_type string, value double")


@query(
    "M5 M10 D16 Q6",
    f"""with {_MERGE} select movie_id, media_type, date, popularity, cast(vote_count as integer) as vote_count
    from loaded where date < date '2024-01-18'
    union all select movie_id, media_type, date, popularity, cast(vote_count as integer) from batch""",
)
def warehouse_facts(t: Tables) -> DataFrame:
    """Facts merged into the warehouse, the batch twice: only touched days are rewritten."""
    warehouse = Warehouse(t.spark, fresh_path(t.spark, "warehouse"))
    for rows in (_loaded(t), _batch(t), _batch(t)):
        warehouse.merge("fact_daily_trends", rows, lambda old, new: merge.upsert(old, new, _FACT_KEY))
    facts = warehouse.read("fact_daily_trends")
    return facts.select("movie_id", "media_type", "date", "popularity", "vote_count")


@query(
    "T5",
    f"""with {CHART} select movie_id, media_type, date, cast(day(date) as integer) as position from chart
    where movie_id in (select p_partkey from part) order by date, position, media_type, movie_id limit 20 offset 140""",
)
def warehouse_page(t: Tables) -> DataFrame:
    """The eighth page of all facts: the days before its own are passed over by their row counts."""
    warehouse = _star(t)
    jobs.upsert_facts(warehouse, _charted_titles(t))
    return warehouse.page("fact_daily_trends", 8).select("movie_id", "media_type", "date", "position")


@query(
    "S16 Q6",
    f"""with {_MERGE}, runs(name, n) as (
      select 'first', count(*) from loaded union all select 'second', count(*) from batch)
    select name as "table", n as rows_read, n as rows_written, 'SUCCESS' as status, cast(null as varchar) as error
    from runs""",
)
def run_summary(t: Tables) -> DataFrame:
    """Row counts observed while the tables were written."""
    rows = []
    for name, df in (("first", _loaded(t)), ("second", _batch(t))):
        written = commits.write_counted(df, fresh_path(t.spark, "run"), "overwrite", ["date"])
        rows.append({"table": name, "rows_read": written, "rows_written": written, "status": "SUCCESS"})
    return layers.run_summary(t.spark, rows)


@query(
    "S3 S16 Q1 Q7",
    f"""with {CHART}, reports(name, rows_written, status) as (
      select 'trending_movies', count(*), 'SUCCESS' from chart
      where date = date '2024-01-15'
      union all select 'trending_tv', null, 'FAILED' union all select 'trending_people', 0, 'EMPTY')
    select name as "table", rows_written, status, 'partial_failure' as outcome from reports""",
)
def ingest_reports(t: Tables) -> DataFrame:
    """One good feed, one whose records lack a required field, one without records."""
    base = fresh_path(t.spark, "ingest")
    _landed(t, base)
    shows = model.content(t).select("id", F.col("title").alias("name"), F.col("extraction_date").alias("date"))
    landing.write_landing(shows, base, "trending_tv")
    nobody = shows.select("id", "name").filter(F.lit(False))
    landing.write_snapshot(nobody, landing.landing_path(base, "trending_people", "2024-01-15"))
    reports = jobs.raw_to_bronze(t.spark, base, dt.date(2024, 1, 15))
    summary = layers.run_summary(t.spark, reports).select("table", "rows_written", "status")
    return summary.withColumn("outcome", F.lit(quality.overall_status(reports, [])))
