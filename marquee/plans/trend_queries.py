"""Registered queries: daily trends, rolling averages and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import finance, rollups, trends
from marquee.plans import model
from marquee.plans.model import Tables
from marquee.plans.registry import CHART, CONTENT, MONEY, SALES, UNIT, WORDS, exact, half_up, query, rounded

TITLE = ["media_type", "movie_id"]


@query(
    "S5",
    f"with {CHART} select movie_id, media_type, date, popularity, vote_average, vote_count from scored",
)
def daily_chart(t: Tables) -> DataFrame:
    return model.chart(t)


@query("W4", f"with {CHART} select movie_id, media_type, date, popularity, position from fact")
def daily_positions(t: Tables) -> DataFrame:
    return model.fact(t).select("movie_id", "media_type", "date", "popularity", "position")


@query(
    "W4",
    f"""with {CHART} select movie_id, media_type, date, popularity,
    dense_rank() over (partition by date, media_type order by units desc) as position from scored""",
)
def daily_positions_per_type(t: Tables) -> DataFrame:
    ranked = trends.daily_positions(model.chart(t), "date", per_type=True)
    return ranked.select("movie_id", "media_type", "date", "popularity", "position")


_TRENDS = f"""{CHART},
lagged as (
  select movie_id, media_type, date, popularity, vote_average, vote_count, position,
         lag(position) over h as prev_position, lag(popularity) over h as prev_popularity,
         count(*) over (h rows between unbounded preceding and current row) as days_on_chart
  from fact window h as (partition by media_type, movie_id order by date)),
moved as (
  select *, prev_position - position as position_change, popularity - prev_popularity as popularity_delta,
         prev_position is null as is_new_entry from lagged)"""


@query("W4 W5 W6 W7", f"with {_TRENDS} select * from moved")
def daily_trends(t: Tables) -> DataFrame:
    return trends.day_over_day(model.fact(t), TITLE, "date")


@query("W4 W5 W6 W7", f"with {_TRENDS} select * from moved")
def daily_trends_extended(t: Tables) -> DataFrame:
    """The first 20 days as already computed, the rest added from each title's last row."""
    chart, first = model.chart(t), F.lit("2024-01-21").cast("date")
    known = trends.day_over_day(trends.daily_positions(chart.filter(F.col("date") < first), "date"), TITLE, "date")
    fresh = trends.extend_daily_trends(known, chart.filter(F.col("date") >= first), TITLE, "date")
    return known.unionByName(fresh)


@query(
    "W5 P11 T1",
    f"""with {_TRENDS} select movie_id, media_type, date, popularity, position, prev_position, position_change,
    popularity_delta, is_new_entry, days_on_chart
    from moved where date = (select max(date) from moved) order by position, media_type, movie_id limit 20""",
)
def leaders_today(t: Tables) -> DataFrame:
    """What rose today: the latest day's first 20 rows with their movement."""
    moved = trends.day_over_day(model.fact(t), TITLE, "date")
    today = moved.filter(F.col("date") == model.newest_day(t))
    shown = today.select(
        "movie_id", "media_type", "date", "popularity", "position", "prev_position", "position_change",
        "popularity_delta", "is_new_entry", "days_on_chart",
    )
    return shown.orderBy("position", "media_type", "movie_id").limit(20)


@query(
    "W8",
    f"""with {CHART}, previous as (
      select movie_id, media_type, date, position,
             lag(position) over (partition by movie_id, media_type order by date) as prev_position from fact)
    select *, coalesce(prev_position - position, 0) as position_change from previous""",
)
def position_changes(t: Tables) -> DataFrame:
    rows = model.fact(t).select("movie_id", "media_type", "date", "position")
    return trends.position_changes(rows, ["movie_id", "media_type"])


@query(
    "J5",
    f"""with {CHART}, newest as (select max(date) as day from fact)
    select c.movie_id, c.media_type, c.position, coalesce(p.position - c.position, 0) as position_change
    from fact c join newest on c.date = day
    left join fact p on p.date = day - interval 1 day and p.movie_id = c.movie_id and p.media_type = c.media_type""",
)
def changes_since_yesterday(t: Tables) -> DataFrame:
    newest = model.newest_day(t)
    fact = model.fact(t, F.date_sub(newest, 1))
    rows = fact.select("movie_id", "media_type", "position", "date")
    current = rows.filter(F.col("date") == newest).drop("date")
    previous = rows.filter(F.col("date") == F.date_sub(newest, 1))
    return trends.changes_between(current, previous, ["movie_id", "media_type"])


_ROLLING = f"""{CHART}, framed as (
      select movie_id, media_type, date, popularity, vote_average, vote_count,
             sum(units) over week as s, count(units) over week as rolling_7d_data_points,
             sum(vote_count) over week as v, count(vote_count) over week as vn,
             sum(score_units) over month as m, count(score_units) over month as rolling_30d_data_points
      from scored
      window week as (partition by media_type, movie_id order by date rows between 6 preceding and current row),
             month as (partition by media_type, movie_id order by datediff('day', date '1970-01-01', date)
                       range between 29 preceding and current row)),
    rolled as (
    select movie_id, media_type, date, popularity, vote_average, vote_count,
           rolling_7d_data_points, rolling_30d_data_points,
           {half_up("s", f"rolling_7d_data_points * {UNIT}", 4)} as rolling_7d_avg_popularity,
           {half_up("m", f"rolling_30d_data_points * {UNIT}", 4)} as rolling_30d_avg_vote_average,
           {half_up("v", "vn", 2)} as rolling_7d_avg_vote_count from framed)"""


@query("W15 W16 W17 F9", f"with {_ROLLING} select * from rolled")
def rolling_averages(t: Tables) -> DataFrame:
    return trends.rolling_averages(model.chart(t), TITLE, "date")


@query("W15 W16 W17", f"with {_ROLLING} select * from rolled where date >= date '2024-01-21'")
def rolling_averages_since(t: Tables) -> DataFrame:
    """Only the later days, from the rows their frames can reach."""
    return trends.rolling_averages_since(model.chart(t), F.lit("2024-01-21").cast("date"), TITLE, "date")


_WEEKLY_CONTENT = f"""{CONTENT},
weekly as (
  select id, title, media_type, strftime(extraction_date, '%G-W%V') as year_week,
         cast(cast(sum({exact("popularity")}) as varchar) as double) / count(popularity) as avg_popularity,
         max(popularity) as peak_popularity,
         cast(cast(sum({exact("vote_average")}) as varchar) as double) / count(vote_average) as avg_vote_average,
         cast(sum(vote_count) as bigint) as total_vote_count, count(*) as days_tracked,
         coalesce(array_to_string(any_value(genres), ', '), '') as genres
  from content group by 1, 2, 3, 4)"""


@query("A2 F5 S14", f"with {_WEEKLY_CONTENT} select * from weekly")
def weekly_content(t: Tables) -> DataFrame:
    return rollups.weekly_content(model.content(t)).withColumn("genres", F.concat_ws(", ", "genres"))


@query(
    "W9 A2 F5 T2",
    f"""with {_WEEKLY_CONTENT}, ranked as (
      select * exclude (genres), dense_rank() over (partition by year_week order by avg_popularity desc) as weekly_rank
      from weekly)
    select * from ranked where weekly_rank <= 20 order by year_week, weekly_rank""",
)
def weekly_rankings(t: Tables) -> DataFrame:
    ranked = rollups.weekly_rankings(model.content(t)).drop("genres")
    return ranked.orderBy("year_week", "weekly_rank")


_MONTHLY_STATS = f"""{CONTENT},
tagged as (
  select id, title, media_type, strftime(extraction_date, '%Y-%m') as year_month, units, popularity, score_units, vote_count,
         unnest(genres) as genre from content),
totals as (
  select genre, year_month, count(distinct id) as title_count,
         {half_up("sum(units)", f"count(units) * {UNIT}", 2)} as avg_popularity,
         {half_up("sum(score_units)", f"count(score_units) * {UNIT}", 2)} as avg_vote_average,
         cast(sum(vote_count) as bigint) as total_vote_count, max(popularity) as peak_popularity
  from tagged group by 1, 2),
leaders as (
  select genre, year_month, title as top_title,
         row_number() over (partition by genre, year_month order by units desc, id, media_type desc) as place
  from tagged where genre is not null)"""


@query(
    "A4 W12 J2 F1 F6 P10",
    f"""with {_MONTHLY_STATS} select totals.*, top_title from totals join leaders using (genre, year_month)
    where place = 1""",
)
def monthly_genre_stats(t: Tables) -> DataFrame:
    return rollups.monthly_genre_stats(model.content(t))


_WEEKLY = f"""{CHART},
weekly as (
  select movie_id, media_type, cast(date_trunc('week', date) as date) as week_start, count(*) as days_trending,
         {half_up("sum(position)", "count(position)", 1)} as avg_position, min(position) as best_position,
         {rounded("sum(units)", "count(units)", 1)} as tenths
  from fact group by 1, 2, 3),
summary as (select * exclude (tenths), tenths / 10e0 as avg_popularity from weekly)"""


@query("A3 F7", f"with {_WEEKLY} select * from summary")
def weekly_summary(t: Tables) -> DataFrame:
    return rollups.weekly_summary(model.fact(t))


@query(
    "W10",
    f"""with {_WEEKLY} select movie_id, media_type, week_start, avg_popularity,
    dense_rank() over (partition by week_start order by avg_popularity desc) as weekly_rank from summary""",
)
def weekly_ranks(t: Tables) -> DataFrame:
    weekly = rollups.weekly_summary(model.fact(t))
    return rollups.weekly_ranks(weekly.select("movie_id", "media_type", "week_start", "avg_popularity"))


WEEKLY_CHANGE = f"""{_WEEKLY},
based as (
  select *, lag(tenths) over (partition by media_type, movie_id order by week_start) as base from weekly),
changed as (
  select movie_id, media_type, week_start, days_trending, avg_position, best_position, tenths / 10e0 as avg_popularity,
         coalesce(case when base > 0 then {half_up("(tenths - base) * 100", "base", 1)} end, 0e0)
         as popularity_change_pct
  from based)"""


@query("W11", f"with {WEEKLY_CHANGE} select * from changed")
def week_over_week(t: Tables) -> DataFrame:
    return rollups.week_over_week(rollups.weekly_summary(model.fact(t)))


@query(
    "A6 W18 J3",
    f"""with {WORDS}, {SALES}, daily as (
      select date, genre_id, name as genre_name, count(*) as trending_count,
             {rounded("sum(units)", "count(units)", 1)} as tenths,
             {half_up("sum(quantity)", f"count(quantity) * {UNIT}", 2)} as avg_vote_average
      from sales join bridge using (movie_id) join genres using (genre_id) group by 1, 2, 3),
    framed as (
      select *, sum(tenths) over f as s, count(tenths) over f as n from daily
      window f as (partition by genre_id order by date rows between 29 preceding and current row))
    select date, genre_id, genre_name, trending_count, tenths / 10e0 as avg_popularity, avg_vote_average,
           {half_up("s", "n * 10", 1)} as avg_popularity_30d from framed""",
)
def daily_genre_trends(t: Tables) -> DataFrame:
    words = model.genre_words(t).withColumn("genre_id", model.genre_id(F.col("genre_name")))
    return rollups.daily_genre_trends(model.sales(t), words)


MONTHLY = f"""{WORDS}, {SALES}, {MONEY},
monthly as (
  select cast(date_trunc('month', date) as date) as month, genre_id, count(distinct sales.movie_id) as trending_count,
         {half_up("sum(units)", f"count(units) * {UNIT}", 1)} as avg_popularity,
         {half_up("sum(quantity)", f"count(quantity) * {UNIT}", 2)} as avg_vote_average,
         cast(sum(budget) as bigint) as total_budget, cast(sum(revenue) as bigint) as total_revenue
  from sales join bridge using (movie_id) left join money using (movie_id) group by 1, 2),
leading_rows as (
  select cast(date_trunc('month', date) as date) as month, genre_id, movie_id as top_movie_id,
         row_number() over (partition by date_trunc('month', date), genre_id order by units desc, movie_id) as place
  from sales join bridge using (movie_id)),
monthly_genres as (
  select monthly.*, top_movie_id,
         case when total_budget > 0 then {half_up("(total_revenue - total_budget) * 100", "total_budget", 1)} end
         as avg_roi
  from monthly join leading_rows using (month, genre_id) where place = 1)"""


@query("A5 A7 F8 F13 J3 J4", f"with {MONTHLY} select * from monthly_genres")
def monthly_genres(t: Tables) -> DataFrame:
    return rollups.monthly_genres(model.sales(t), model.bridge(t), model.money(t))


@query(
    "A7 J7",
    f"""with {WORDS}, {CHART}, placed as (
      select cast(date_trunc('month', date) as date) as month, genre_id, movie_id as top_movie_id,
             popularity as peak_popularity,
             row_number() over (partition by date_trunc('month', date), genre_id order by units desc, movie_id) as place
      from scored join bridge using (movie_id))
    select * exclude (place) from placed where place = 1""",
)
def top_movie_per_genre(t: Tables) -> DataFrame:
    linked = rollups.per_title_month(model.chart(t)).join(model.bridge(t), "movie_id")
    return linked.groupBy("month", "genre_id").agg(
        rollups.top_movie().alias("top_movie_id"), F.max("_peak").alias("peak_popularity")
    )


def _priced_titles(t: Tables) -> DataFrame:
    names = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.split("p_name", " ").alias("genres")
    )
    return names.join(model.money(t).withColumnRenamed("movie_id", "id"), "id")


@query(
    "F10 F11 F12 P9",
    f"""with {MONEY} select movie_id, budget, revenue,
    {half_up("revenue - budget", "budget", 4)} as roi_ratio,
    {half_up("(revenue - budget) * 100", "budget", 1)} as roi_pct,
    cast(revenue - budget as double) / cast(budget as double) * 100 as roi_pct_unrounded,
    {half_up("(revenue - budget) * 100", "revenue", 2)} as profit_margin_pct
    from money where budget > 0 and revenue is not null""",
)
def title_returns(t: Tables) -> DataFrame:
    priced = finance.has_finances(model.money(t)).drop("release_date")
    return priced.withColumns(
        {
            "roi_ratio": finance.roi_ratio(),
            "roi_pct": finance.roi_pct(),
            "roi_pct_unrounded": finance.roi_pct(digits=None),
            "profit_margin_pct": finance.profit_margin_pct(),
        }
    )


_ROI = f"""{MONEY},
priced as (
  select movie_id as id, p_name as title, unnest(coalesce(string_split(p_name, ' '), [null])) as genre, release_date, budget, revenue,
         {half_up("revenue - budget", "budget", 4)} as roi,
         {half_up("(revenue - budget) * 100", "revenue", 2)} as profit_margin_pct
  from money join part on p_partkey = movie_id where budget > 0 and revenue is not null),
ranked as (
  select *, rank() over (partition by genre order by roi desc) as roi_genre_rank from priced)"""


@query("W13 F1 F10", f"with {_ROI} select id, genre, roi, roi_genre_rank from ranked")
def roi_by_genre(t: Tables) -> DataFrame:
    return finance.roi_ranked(_priced_titles(t)).select("id", "genre", "roi", "roi_genre_rank")


@query(
    "W13 W14 F10 F12 P9",
    f"""with {_ROI}, framed as (
      select *, sum(cast(round(roi * 10000) as bigint)) over f as s, count(roi) over f as n from ranked
      window f as (partition by genre order by release_date, id rows between 9 preceding and current row))
    select id, title, genre, release_date, budget, revenue, roi, profit_margin_pct, roi_genre_rank,
           {half_up("s", "n * 10000", 4)} as rolling_avg_roi from framed""",
)
def roi_analysis(t: Tables) -> DataFrame:
    return finance.roi_analysis(_priced_titles(t), day=None).drop("genres")


@query(
    "W13 W1 P8",
    f"""with {CONTENT}, {MONEY}, seen as (
      select id, max(extraction_date) as extraction_date from content group by 1),
    priced as (
      select id, extraction_date, unnest(coalesce(string_split(p_name, ' '), [null])) as genre,
             {half_up("revenue - budget", "budget", 4)} as roi
      from seen join part on p_partkey = id join money on movie_id = id where budget > 0)
    select *, rank() over (partition by genre order by roi desc) as roi_genre_rank from priced""",
)
def roi_of_charted_titles(t: Tables) -> DataFrame:
    """A title charted on many days counts once, with its latest row."""
    rows = model.content(t).join(model.money(t).withColumnRenamed("movie_id", "id"), "id")
    latest = finance.latest_per_title(rows, ["id"])
    return finance.roi_ranked(latest).select("id", "extraction_date", "genre", "roi", "roi_genre_rank")


@query(
    "P8",
    f"""with {CHART} select movie_id, date, media_type, popularity, cast(null as double) as budget,
    cast(null as double) as revenue from scored""",
)
def feed_without_money(t: Tables) -> DataFrame:
    feed = model.chart(t).select("movie_id", "date", "media_type", "popularity")
    return finance.with_missing_money(feed)
