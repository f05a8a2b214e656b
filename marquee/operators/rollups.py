"""Weekly, monthly and daily-genre roll-ups.

Measures are combined before genres are exploded or joined: a month of daily
rows becomes one row per title first, which is what then fans out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.calendar import iso_week_label, month_label, month_start, week_start
from marquee.functions.exact import fixed, mean, percent, unfixed
from marquee.operators.ranking import group_rank

TOP_WEEKLY = 20


def weekly_content(df: DataFrame, day: str = "extraction_date") -> DataFrame:
    """One row per title and ISO week."""
    units = df.withColumns(
        {"year_week": iso_week_label(day), "_popularity": fixed("popularity"), "_vote_average": fixed("vote_average")}
    )
    summed = units.groupBy("id", "title", "media_type", "year_week").agg(
        F.sum("_popularity").alias("_popularity_sum"),
        F.count("_popularity").alias("_popularity_rows"),
        F.max("popularity").alias("peak_popularity"),
        F.sum("_vote_average").alias("_vote_sum"),
        F.count("_vote_average").alias("_vote_rows"),
        F.sum("vote_count").alias("total_vote_count"),
        F.count("*").alias("days_tracked"),
        F.max_by("genres", F.col(day)).alias("genres"),
    )
    return summed.withColumns(
        {
            "avg_popularity": F.try_divide(unfixed("_popularity_sum"), F.col("_popularity_rows")),
            "avg_vote_average": F.try_divide(unfixed("_vote_sum"), F.col("_vote_rows")),
        }
    ).drop("_popularity_sum", "_popularity_rows", "_vote_sum", "_vote_rows")


def weekly_rankings(df: DataFrame, top_n: int = TOP_WEEKLY, day: str = "extraction_date") -> DataFrame:
    """The top n ranks of each week, ties kept: values are ranked, so titles that share one do not meet in a task."""
    weekly = weekly_content(df, day)
    return group_rank(weekly, ["year_week"], [("avg_popularity", "desc")], "dense_rank", "weekly_rank", top_n)


def monthly_genre_stats(df: DataFrame, day: str = "extraction_date") -> DataFrame:
    """Titles, averages, votes, peak and top title per genre and month."""
    units = df.withColumns(
        {"year_month": month_label(day), "_popularity": fixed("popularity"), "_vote_average": fixed("vote_average")}
    )
    per_title = units.groupBy("year_month", "media_type", "id", "title", "genres").agg(
        F.sum("_popularity").alias("_popularity"),
        F.count("_popularity").alias("_popularity_rows"),
        F.sum("_vote_average").alias("_vote_average"),
        F.count("_vote_average").alias("_vote_rows"),
        F.sum("vote_count").alias("vote_count"),
        F.max("popularity").alias("_peak"),
    )
    by_genre = per_title.withColumn("genre", F.explode("genres")).filter(F.col("genre").isNotNull())
    leader = F.struct(F.col("_peak"), -F.col("id"), F.col("media_type"), F.col("title"))
    return (
        by_genre.groupBy("genre", "year_month")
        .agg(
            F.count_distinct("id").alias("title_count"),
            F.sum("_popularity").alias("_popularity"),
            F.sum("_popularity_rows").alias("_popularity_rows"),
            F.sum("_vote_average").alias("_vote_average"),
            F.sum("_vote_rows").alias("_vote_rows"),
            F.sum("vote_count").alias("total_vote_count"),
            F.max("_peak").alias("peak_popularity"),
            F.max_by("title", leader).alias("top_title"),
        )
        .withColumns(
            {
                "avg_popularity": mean("_popularity", "_popularity_rows", 2),
                "avg_vote_average": mean("_vote_average", "_vote_rows", 2),
            }
        )
        .drop("_popularity", "_popularity_rows", "_vote_average", "_vote_rows")
    )


def weekly_summary(fact: DataFrame, day: str = "date") -> DataFrame:
    """Days, positions and popularity per title and Monday week."""
    return (
        fact.withColumns({"week_start": week_start(day), "_popularity": fixed("popularity")})
        .groupBy("movie_id", "media_type", "week_start")
        .agg(
            F.count("*").alias("days_trending"),
            mean(F.sum(F.col("position").cast("bigint")), F.count("position"), 1).alias("avg_position"),
            F.min("position").alias("best_position"),
            mean(F.sum("_popularity"), F.count("_popularity"), 1).alias("avg_popularity"),
        )
    )


def weekly_ranks(weekly: DataFrame) -> DataFrame:
    return group_rank(weekly, ["week_start"], [("avg_popularity", "desc")], "dense_rank", "weekly_rank")


def week_over_week(weekly: DataFrame) -> DataFrame:
    """Popularity change in percent against the title's previous week, 0 without a positive base."""
    history = Window.partitionBy("media_type", "movie_id").orderBy("week_start")
    now, before = fixed("avg_popularity"), F.lag(fixed("avg_popularity")).over(history)
    # The previous week is a column of its own: the window runs once for both uses.
    kept = weekly.withColumn("_before", before)
    change = F.when(F.col("_before") > 0, percent(now - F.col("_before"), F.col("_before"), 1))
    return kept.withColumn("popularity_change_pct", F.coalesce(change, F.lit(0.0))).drop("_before")


def daily_genre_trends(fact: DataFrame, genres: DataFrame) -> DataFrame:
    """Rows, popularity and rating per day and genre, with a 30-row moving average.

    Rows of a title and day are combined before the join, so a title with most
    of the rows meets the bridge as one row per day. The moving window runs over
    the days of one genre, so it is bounded by the days kept.
    """
    per_title = _measures(fact, ["date", "movie_id"])
    joined = per_title.join(genres.select("movie_id", "genre_id", "genre_name"), "movie_id")
    daily = joined.groupBy("date", "genre_id", "genre_name").agg(
        F.sum("_rows").alias("trending_count"),
        mean(F.sum("_popularity"), F.sum("_popularity_rows"), 1).alias("avg_popularity"),
        mean(F.sum("_vote_average"), F.sum("_vote_rows"), 2).alias("avg_vote_average"),
    )
    return moving_genre_popularity(daily)


def moving_genre_popularity(daily: DataFrame) -> DataFrame:
    frame = Window.partitionBy("genre_id").orderBy("date").rowsBetween(-29, Window.currentRow)
    exact = fixed("avg_popularity")
    moved = daily.withColumns({"_sum": F.sum(exact).over(frame), "_rows": F.count(exact).over(frame)})
    return moved.withColumn("avg_popularity_30d", mean("_sum", "_rows", 1)).drop("_sum", "_rows")


def _measures(fact: DataFrame, by: list[str]) -> DataFrame:
    """Sums and counts from which averages over any union of the groups follow exactly."""
    units = fact.withColumns({"_popularity": fixed("popularity"), "_vote_average": fixed("vote_average")})
    return units.groupBy(*by).agg(
        F.count("*").alias("_rows"),
        F.sum("_popularity").alias("_popularity"),
        F.count("_popularity").alias("_popularity_rows"),
        F.sum("_vote_average").alias("_vote_average"),
        F.count("_vote_average").alias("_vote_rows"),
        F.max("popularity").alias("_peak"),
    )


def per_title_month(fact: DataFrame, day: str = "date") -> DataFrame:
    """Monthly measures per title: what joins to genres instead of the daily rows."""
    return _measures(fact.withColumn("month", month_start(day)), ["month", "movie_id"])


def monthly_genres(fact: DataFrame, bridge: DataFrame, finance: DataFrame | None = None) -> DataFrame:
    """Monthly star-schema aggregate per genre, with its most popular title.

    `finance` (movie_id, budget, revenue) counts once per daily row, as a sum
    over the daily fact does. A title without a genre belongs to no group.
    """
    titles = per_title_month(fact)
    if finance is not None:
        money = finance.select("movie_id", "budget", "revenue")
        titles = titles.join(money, "movie_id", "left")
    else:
        titles = titles.withColumns({"budget": F.lit(None).cast("bigint"), "revenue": F.lit(None).cast("bigint")})
    linked = titles.join(bridge.select("movie_id", "genre_id"), "movie_id")
    totals = linked.groupBy("month", "genre_id").agg(
        F.count("movie_id").alias("trending_count"),
        mean(F.sum("_popularity"), F.sum("_popularity_rows"), 1).alias("avg_popularity"),
        mean(F.sum("_vote_average"), F.sum("_vote_rows"), 2).alias("avg_vote_average"),
        top_movie().alias("top_movie_id"),
        F.sum(F.col("budget") * F.col("_rows")).alias("total_budget"),
        F.sum(F.col("revenue") * F.col("_rows")).alias("total_revenue"),
    )
    return totals.withColumn("avg_roi", pooled_roi("total_budget", "total_revenue"))


def top_movie() -> Column:
    """Id with the highest peak, the smallest id on a tie."""
    return F.max_by("movie_id", F.struct(F.col("_peak"), -F.col("movie_id")))


def pooled_roi(budget: str, revenue: str) -> Column:
    """Return in percent of the summed budgets; null without a budget."""
    return F.when(F.col(budget) > 0, percent(F.col(revenue) - F.col(budget), F.col(budget), 1))
