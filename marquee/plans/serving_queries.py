"""Registered queries: what the dashboard and the API read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators import rollups, serving
from marquee.plans import model
from marquee.plans.model import Tables
from marquee.functions.exact import fixed
from marquee.plans.registry import CAST, CHART, MONEY, UNIT, WORDS, exact, half_up, query
from marquee.plans.trend_queries import MONTHLY, WEEKLY_CHANGE

_MEDIA = "click"

_TITLES = """
titles as (
  select p_partkey as movie_id, p_name as movie_title,
         'https://images.example.org/t/w500/' || p_partkey || '.jpg' as poster_url from part)"""

_FACT = f"""{CHART}, {_TITLES}, newest as (select max(date) as day from fact)"""

_FACT_COLUMNS = "movie_id, media_type, date, position, popularity, vote_average, vote_count"


def _fact_on(t: Tables, day: Column) -> DataFrame:
    return model.fact(t, day, day)


def _newest_week(t: Tables) -> Column:
    return t.events.agg(F.date_trunc("week", F.max("ts").cast("date")).cast("date")).scalar()


def _weekly(t: Tables) -> DataFrame:
    return rollups.week_over_week(rollups.weekly_summary(model.fact(t)))


def _monthly(t: Tables) -> DataFrame:
    return rollups.monthly_genres(model.sales(t), model.bridge(t), model.money(t))


@query(
    "A8 A9 P11",
    f"""with {_FACT}, {WORDS}
    select (select count(*) from part) as total_movies, (select count(*) from genres) as total_genres,
           max(date) as latest_date, count(*) as trending_today,
           {half_up("sum(score_units)", f"count(score_units) * {UNIT}", 1)} as avg_rating
    from fact join newest on date = day""",
)
def dashboard_kpis(t: Tables) -> DataFrame:
    # Positions are not needed, so the chart is read unranked.
    newest = model.newest_day(t)
    return serving.kpis(model.chart(t, newest), t.part, model.genres(t), newest)


@query(
    "T1 J9 P11",
    f"""with {_FACT} select {_FACT_COLUMNS}, movie_title, poster_url from (
      select fact.* from fact join newest on date = day where media_type = '{_MEDIA}'
      order by position, movie_id limit 5) join titles using (movie_id)""",
)
def top_trending(t: Tables) -> DataFrame:
    newest = model.newest_day(t)
    return serving.top_trending(_fact_on(t, newest), model.titles(t), _MEDIA, newest=newest)


_GENRE_ROWS = f"""{_FACT}, {WORDS},
counted as (
  select name as genre_name, count(*) as n from fact join newest on date = day
  join bridge using (movie_id) join genres using (genre_id) group by 1)"""


@query(
    "A10 J10",
    f"""with {_GENRE_ROWS} select genre_name, n as "rows" from counted order by n desc, genre_name limit 10""",
)
def genre_distribution(t: Tables) -> DataFrame:
    newest = model.newest_day(t)
    return serving.genre_distribution(model.chart(t, newest), model.bridge(t), model.genres(t), newest=newest)


@query(
    "A11 J10",
    f"""with {_GENRE_ROWS}, whole as (select sum(n) as total from counted)
    select genre_name, n as "rows", {half_up("n * 100", "total", 2)} as share_pct from counted, whole""",
)
def genre_shares(t: Tables) -> DataFrame:
    newest = model.newest_day(t)
    today = serving.on_latest(model.chart(t, newest), newest=newest)
    return serving.with_share(serving.genre_counts(today, model.bridge(t), model.genres(t)))


@query(
    "A12 J8 P13 F21",
    f"""with {_FACT}, leaders as (
      select movie_id from fact join newest on date = day where media_type = '{_MEDIA}'
      order by position, movie_id limit 5)
    select movie_id, substr(movie_title, 1, 25) as name,
           string_agg(strftime(date, '%Y-%m-%d'), ',' order by date, media_type) as dates,
           string_agg(cast({exact("popularity")} as varchar), ',' order by date, media_type) as units
    from fact join newest on date >= day - interval 6 day join leaders using (movie_id) join titles using (movie_id)
    group by 1, 2""",
)
def popularity_timeline(t: Tables) -> DataFrame:
    newest = model.newest_day(t)
    week = model.fact(t, F.date_sub(newest, 6))
    series = serving.popularity_timeline(week, model.titles(t), _MEDIA, newest=newest)
    units = F.transform("values", lambda v: fixed(v).cast("string"))
    return series.select(
        "movie_id",
        "name",
        F.concat_ws(",", F.transform("dates", lambda d: d.cast("string"))).alias("dates"),
        F.concat_ws(",", units).alias("units"),
    )


@query(
    "P12 P11 J9 T2",
    f"""with {_FACT} select {_FACT_COLUMNS}, movie_title, poster_url
    from fact join newest on date = day join titles using (movie_id) order by position""",
)
def daily_page(t: Tables) -> DataFrame:
    """A malformed date shows the latest day."""
    newest = model.newest_day(t)
    return serving.daily_page(_fact_on(t, newest), model.titles(t), "2024-13-01", "all", newest)


@query(
    "P12 J9 T2",
    f"""with {_FACT} select {_FACT_COLUMNS}, movie_title, poster_url from fact join titles using (movie_id)
    where date = date '2024-01-15' and media_type = '{_MEDIA}'""",
)
def daily_page_of_day(t: Tables) -> DataFrame:
    day = "2024-01-15"
    return serving.daily_page(_fact_on(t, F.lit(day).cast("date")), model.titles(t), day, _MEDIA)


@query(
    "P12 J9",
    f"""with {_FACT} select {_FACT_COLUMNS}, movie_title, poster_url from fact join titles using (movie_id)""",
)
def daily_api(t: Tables) -> DataFrame:
    return serving.daily_api(model.fact(t), model.titles(t))


@query(
    "T5 P12",
    f"""with {_FACT} select {_FACT_COLUMNS}, movie_title, poster_url from fact join titles using (movie_id)
    order by position, date, media_type, movie_id limit 20 offset 20""",
)
def daily_api_second_page(t: Tables) -> DataFrame:
    return serving.page(serving.daily_api(model.fact(t), model.titles(t)), 2)


_WEEK = f"""{WEEKLY_CHANGE}, {_TITLES}, newest_week as (select max(week_start) as week from changed),
this_week as (select changed.* from changed join newest_week on week_start = week)"""


@query(
    "J11 T1 P11",
    f"""with {_WEEK}, first_rows as (select * from this_week order by avg_position, media_type, movie_id limit 20)
    select first_rows.*, movie_title, poster_url from first_rows join titles using (movie_id)""",
)
def weekly_leaders(t: Tables) -> DataFrame:
    return serving.weekly_leaders(_weekly(t), model.titles(t), newest=_newest_week(t))


@query(
    "F21 T1 J11",
    f"""with {_WEEK}, first_rows as (select * from this_week order by avg_position, media_type, movie_id limit 10)
    select movie_id, media_type, substr(movie_title, 1, 20) as movie, avg_position as position,
           popularity_change_pct as change from first_rows join titles using (movie_id)""",
)
def weekly_positions_chart(t: Tables) -> DataFrame:
    leaders = serving.weekly_leaders(_weekly(t), model.titles(t), newest=_newest_week(t))
    return serving.weekly_positions_chart(leaders)


@query(
    "T1 J11",
    f"""with {_WEEK}, first_rows as (
      select * from this_week order by popularity_change_pct desc, media_type, movie_id limit 5)
    select first_rows.*, movie_title, poster_url from first_rows join titles using (movie_id)""",
)
def top_risers(t: Tables) -> DataFrame:
    return serving.top_movers(_weekly(t), model.titles(t), True, newest=_newest_week(t))


@query(
    "T1 J11",
    f"""with {_WEEK}, first_rows as (
      select * from this_week order by popularity_change_pct, media_type, movie_id limit 5)
    select first_rows.*, movie_title, poster_url from first_rows join titles using (movie_id)""",
)
def top_fallers(t: Tables) -> DataFrame:
    return serving.top_movers(_weekly(t), model.titles(t), False, newest=_newest_week(t))


@query(
    "J11 P12",
    f"with {_WEEK} select changed.*, movie_title from changed join titles using (movie_id)",
)
def weekly_api(t: Tables) -> DataFrame:
    return serving.weekly_api(_weekly(t), model.titles(t))


@query("T3", "select distinct cast(ts as date) as date from events order by date desc limit 30")
def newest_days(t: Tables) -> DataFrame:
    return serving.newest_values(t.events.select(F.col("ts").cast("date").alias("date")), "date", 30)


@query(
    "T3",
    """select distinct cast(date_trunc('month', l_shipdate) as date) as month from lineitem
    order by month desc limit 12""",
)
def newest_months(t: Tables) -> DataFrame:
    return serving.newest_values(t.lineitem.select(F.trunc("l_shipdate", "MM").alias("month")), "month", 12)


@query(
    "T3 F7",
    """select distinct cast(date_trunc('week', l_shipdate) as date) as week_start from lineitem
    order by week_start desc limit 12""",
)
def newest_weeks(t: Tables) -> DataFrame:
    weeks = t.lineitem.select(F.date_trunc("week", "l_shipdate").cast("date").alias("week_start"))
    return serving.newest_values(weeks, "week_start", 12)


@query(
    "J12 T1",
    f"""with {MONTHLY}, newest as (select max(month) as m from monthly_genres)
    select genres.name as genre_name, trending_count, avg_popularity from monthly_genres join newest on month = m
    join genres using (genre_id) order by trending_count desc, genre_id limit 12""",
)
def genre_bars(t: Tables) -> DataFrame:
    """Bar chart of the latest month's first genres."""
    newest = t.lineitem.agg(F.trunc(F.max("l_shipdate"), "MM")).scalar()
    return serving.genre_bars(_monthly(t), model.genres(t), newest=newest)


@query(
    "J12 P11 T2",
    f"""with {MONTHLY}, newest as (select max(month) as m from monthly_genres)
    select monthly_genres.*, genres.name as genre_name, p_name as top_title from monthly_genres
    join newest on month = m join genres using (genre_id) left join part on p_partkey = top_movie_id""",
)
def monthly_report(t: Tables) -> DataFrame:
    newest = t.lineitem.agg(F.trunc(F.max("l_shipdate").cast("date"), "MM")).scalar()
    return serving.monthly_report(_monthly(t), model.genres(t), model.titles(t), newest)


@query(
    "J12 P12 T2",
    f"""with {MONTHLY} select monthly_genres.*, genres.name as genre_name from monthly_genres
    join genres using (genre_id) where month = date '1998-05-01'""",
)
def monthly_api(t: Tables) -> DataFrame:
    return serving.monthly_api(_monthly(t), model.genres(t), "1998-05-01")


@query(
    "P14 F20 F21",
    f"""with {MONEY} select movie_id, substr(title, 1, 20) as title, budget / 1e6 as budget_m,
    revenue / 1e6 as revenue_m, coalesce(roi, 0e0) as roi,
    least(greatest(abs(coalesce(roi, 0e0)) / 10 + 8, 8e0), 30e0) as bubble
    from movies where budget > 0 and revenue > 0 order by movie_id limit 50""",
)
def budget_scatter(t: Tables) -> DataFrame:
    return serving.budget_scatter(model.movies(t))


@query(
    "A12 P12",
    f"""with {CHART} select date, media_type, popularity, position from fact where movie_id = 7""",
)
def title_timeline(t: Tables) -> DataFrame:
    return serving.title_timeline(model.fact(t), 7)


@query(
    "J13 T4",
    f"""with {CAST}, billed as (
      select *, row_number() over (partition by movie_id order by cast_order, person_id) as place from cast_links)
    select movie_id, person_id, cast_order, s_name as person_name from billed
    join supplier on s_suppkey = person_id where place <= 15""",
)
def movie_cast(t: Tables) -> DataFrame:
    return serving.movie_cast(model.cast(t), model.people(t))


@query(
    "J13 T4",
    f"""with {CAST} select movie_id, person_id, cast_order, s_name as person_name from cast_links
    join supplier on s_suppkey = person_id where movie_id = 5 order by cast_order, person_id limit 15""",
)
def cast_of_movie(t: Tables) -> DataFrame:
    """One title: its line items alone are read."""
    return serving.movie_cast(model.cast(t), model.people(t), movie_id=5)


@query(
    "J13 T6",
    f"""with {CAST}, {MONEY} select movie_id, person_id, cast_order, title, release_date
    from cast_links join movies using (movie_id) where person_id = 3 order by release_date desc nulls last""",
)
def films_of_person(t: Tables) -> DataFrame:
    return serving.filmography(model.cast(t), model.movies(t), person_id=3)


@query(
    "J13 T6",
    f"""with {CAST}, {MONEY} select movie_id, person_id, cast_order, title, release_date
    from cast_links join movies using (movie_id) order by person_id, release_date desc nulls last""",
)
def filmography(t: Tables) -> DataFrame:
    return serving.filmography(model.cast(t), model.movies(t))


@query(
    "J14",
    f"""with {WORDS} select p_partkey as movie_id, p_name as title,
    coalesce(string_agg(genre_id || ':' || name, ',' order by genre_id), '') as genres
    from part left join bridge on movie_id = p_partkey left join genres using (genre_id) group by 1, 2""",
)
def movies_with_genres(t: Tables) -> DataFrame:
    names = model.titles(t).select("movie_id", "title")
    nested = serving.movies_with_genres(names, model.bridge(t), model.genres(t))
    flat = F.transform("genres", lambda g: F.concat(g["genre_id"].cast("string"), F.lit(":"), g["name"]))
    return nested.withColumn("genres", F.concat_ws(",", flat))


@query(
    "T7",
    f"""with {CHART} select movie_id, media_type, vote_average from (
      select *, row_number() over (partition by movie_id, media_type order by date desc) as place from scored)
    where place = 1""",
)
def latest_scores(t: Tables) -> DataFrame:
    return serving.latest_score(model.chart(t))


@query(
    "P15",
    "select p_partkey as movie_id, p_name as title from part where contains(lower(p_name), 'red')",
)
def title_search(t: Tables) -> DataFrame:
    return serving.search(model.titles(t), "title", "ReD").select("movie_id", "title")


@query(
    "P15 P12",
    "select event_id, user_id, value from events where event_type = 'purchase' and user_id = 3",
)
def matching_events(t: Tables) -> DataFrame:
    rows = serving.matching(t.events, event_type="purchase", user_id=3, props=None)
    return rows.select("event_id", "user_id", "value")


@query(
    "S13 P13",
    f"""with {CHART} select movie_id, media_type, date, popularity from scored
    where date >= date '2024-01-23' and date < date '2024-01-30'""",
)
def facts_between_days(t: Tables) -> DataFrame:
    rows = model.chart(t).select("movie_id", "media_type", "date", "popularity")
    return serving.between_days(rows, F.lit("2024-01-23").cast("date"), F.lit("2024-01-30").cast("date"))


@query(
    "S13 P13",
    f"""with {CHART}, newest as (select max(date) as day from chart)
    select movie_id, media_type, date, popularity from scored join newest on date >= day - interval 7 day""",
)
def facts_of_last_week(t: Tables) -> DataFrame:
    rows = model.chart(t).select("movie_id", "media_type", "date", "popularity")
    return serving.last_week(rows, model.newest_day(t))


@query(
    "S13 P13 F8",
    """select l_orderkey, l_linenumber, l_partkey, cast(l_shipdate as date) as date from lineitem
    where l_shipdate >= timestamp '1998-04-01' and l_shipdate < timestamp '1998-05-01'""",
)
def sales_of_last_month(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("date"))
    return serving.last_month(rows, F.lit("1998-05-17").cast("date"))


@query(
    "J6 U3",
    f"""with {CHART}, large as (
      select l_partkey, sum(case l_returnflag when 'R' then l_quantity when 'A' then -l_quantity else 0 end) as pieces
      from lineitem group by 1),
    titles as (
      select p_partkey as movie_id, cast(greatest(coalesce(pieces, 0), 0) as bigint) as budget
      from part left join large on l_partkey = p_partkey)
    select distinct movie_id from titles join chart using (movie_id)
    where budget = 0 and date >= (select max(date) from chart) - interval 7 day order by movie_id limit 50""",
)
def titles_to_enrich(t: Tables) -> DataFrame:
    """Budget: pieces returned beyond those accepted, over all line items; none leaves a title to enrich."""
    returned, accepted = F.col("l_returnflag") == "R", F.col("l_returnflag") == "A"
    pieces = F.when(returned, F.col("l_quantity")).when(accepted, -F.col("l_quantity")).otherwise(0)
    known = t.lineitem.groupBy(F.col("l_partkey").alias("movie_id")).agg(F.sum(pieces).alias("_pieces"))
    movies = t.part.select(F.col("p_partkey").alias("movie_id")).join(known, "movie_id", "left")
    movies = movies.withColumn("budget", F.greatest(F.coalesce(F.col("_pieces"), F.lit(0.0)), F.lit(0.0)).cast("bigint"))
    rows = t.events.select(F.col("user_id").alias("movie_id"), F.col("ts").cast("date").alias("date"))
    return serving.titles_to_enrich(rows, movies, model.newest_day(t))


@query(
    "J7",
    f"""with {CHART}, {WORDS} select movie_id, media_type, date, popularity from scored
    where movie_id in (select movie_id from bridge join genres using (genre_id) where name = 'gizmo')""",
)
def facts_of_genre(t: Tables) -> DataFrame:
    wanted = model.genre_id(F.lit("gizmo"))
    rows = model.chart(t).select("movie_id", "media_type", "date", "popularity")
    return serving.genre_movies(rows, model.bridge(t), wanted)


@query("T2", f"with {WORDS} select genre_id, name from genres order by name")
def genre_list(t: Tables) -> DataFrame:
    return serving.listing(model.genres(t), "dim_genres")


@query(
    "T2 T5",
    """select s_suppkey as person_id, s_name as name, s_acctbal as popularity from supplier
    order by s_acctbal desc, s_suppkey limit 20 offset 20""",
)
def people_second_page(t: Tables) -> DataFrame:
    return serving.page(serving.listing(model.people(t), "dim_people"), 2)


@query(
    "T2 T5",
    """select s_suppkey as person_id, s_name as name, s_acctbal as popularity from supplier
    where s_acctbal < 5000 or (s_acctbal = 5000 and s_suppkey > 0) order by s_acctbal desc, s_suppkey limit 20""",
)
def people_after(t: Tables) -> DataFrame:
    """A page by its place in the order instead of its number."""
    return serving.page_after(model.people(t), "dim_people", {"popularity": 5000.0, "person_id": 0})


@query(
    "T2",
    f"""with {MONTHLY} select month, genre_id, trending_count, avg_popularity from monthly_genres
    order by month desc, trending_count desc, genre_id limit 20""",
)
def monthly_list(t: Tables) -> DataFrame:
    rows = _monthly(t).select("month", "genre_id", "trending_count", "avg_popularity")
    return serving.page(serving.listing(rows, "agg_monthly_genres"), 1)
