"""Daily positions, their day-over-day movement and rolling averages per title.

A title has one row per day, so a window over one title is bounded by the number
of days kept. Windows over a day are not bounded and go through `group_rank`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marquee.functions.calendar import epoch_day
from marquee.functions.exact import fixed, mean
from marquee.operators.keys import top_rows
from marquee.operators.ranking import group_rank

TITLE = ["media_type", "id"]


def daily_positions(df: DataFrame, day: str = "extraction_date", per_type: bool = False) -> DataFrame:
    """Dense rank by falling popularity, over all titles of the day or per media type."""
    by = [day, "media_type"] if per_type else [day]
    return group_rank(df, by, [("popularity", "desc")], "dense_rank", "position")


def _history(title: list[str], day: str) -> WindowSpec:
    return Window.partitionBy(*title).orderBy(day)


def day_over_day(df: DataFrame, title: list[str] = TITLE, day: str = "extraction_date") -> DataFrame:
    """Previous position and popularity, their change, new-entry flag and days on the chart.

    All five share one window specification, hence one shuffle and one sort.
    """
    history = _history(title, day)
    previous = df.withColumns(
        {
            "prev_position": F.lag("position").over(history),
            "prev_popularity": F.lag("popularity").over(history),
            "days_on_chart": F.count("*").over(history.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    return previous.withColumns(
        {
            "position_change": F.col("prev_position") - F.col("position"),
            "popularity_delta": F.col("popularity") - F.col("prev_popularity"),
            "is_new_entry": F.col("prev_position").isNull(),
        }
    )


def daily_trends(df: DataFrame, day: str = "extraction_date") -> DataFrame:
    return day_over_day(daily_positions(df, day), TITLE, day)


def title_state(trended: DataFrame, title: list[str] = TITLE, day: str = "extraction_date") -> DataFrame:
    """Each title's last position, popularity and days on the chart.

    The kept columns are numbers, so this is one hash aggregation with a partial
    pass, however long the history.
    """
    return trended.groupBy(*title).agg(
        F.max_by("position", day).alias("_position"),
        F.max_by("popularity", day).alias("_popularity"),
        F.max_by("days_on_chart", day).alias("_days"),
    )


def extend_daily_trends(
    trended: DataFrame, fresh: DataFrame, title: list[str] = TITLE, day: str = "extraction_date"
) -> DataFrame:
    """Trends of days that follow the ones already computed, without recomputing those.

    Equal to the same days of `daily_trends` over all rows: positions look at
    their own day only, and what a title's history contributes is its last row.
    """
    return follow_state(title_state(trended, title, day), fresh, title, day)


def follow_state(
    state: DataFrame, fresh: DataFrame, title: list[str] = TITLE, day: str = "extraction_date"
) -> DataFrame:
    """Trends of days that follow a `title_state`."""
    moved = day_over_day(daily_positions(fresh, day), title, day)
    joined = moved.join(state, title, "left")
    # A title's first fresh row follows its last known one, a later row the fresh row before it.
    opening = F.col("is_new_entry")
    position = F.when(opening, F.col("_position")).otherwise(F.col("prev_position"))
    popularity = F.when(opening, F.col("_popularity")).otherwise(F.col("prev_popularity"))
    return joined.withColumns(
        {
            "prev_position": position,
            "prev_popularity": popularity,
            "days_on_chart": F.col("days_on_chart") + F.coalesce("_days", F.lit(0)),
            "position_change": position - F.col("position"),
            "popularity_delta": F.col("popularity") - popularity,
            "is_new_entry": position.isNull(),
        }
    ).drop("_position", "_popularity", "_days")


def position_changes(df: DataFrame, title: list[str], day: str = "date") -> DataFrame:
    """Change against the title's previous row, 0 where there is none."""
    previous = F.lag("position").over(_history(title, day))
    change = F.coalesce(previous - F.col("position"), F.lit(0))
    return df.withColumns({"prev_position": previous, "position_change": change})


def changes_between(current: DataFrame, previous: DataFrame, title: list[str]) -> DataFrame:
    """Change of each current row against a given earlier day, 0 if the title was absent."""
    before = previous.select(*title, F.col("position").alias("prev_position"))
    moved = F.coalesce(F.col("prev_position") - F.col("position"), F.lit(0))
    return current.join(before, title, "left").withColumn("position_change", moved).drop("prev_position")


def frame_context(df: DataFrame, since: Column, title: list[str] = TITLE, day: str = "extraction_date") -> DataFrame:
    """The rows that frames of days from `since` on can reach: 29 days, and 6 rows per title, back."""
    reach = F.date_sub(since, 29)
    older = top_rows(df.filter(F.col(day) < reach), title, [F.col(day).desc()], 6)
    return df.filter(F.col(day) >= reach).unionByName(older)


def rolling_averages_since(
    df: DataFrame, since: Column, title: list[str] = TITLE, day: str = "extraction_date"
) -> DataFrame:
    """Rolling averages of the days from `since` on only."""
    return rolling_averages(frame_context(df, since, title, day), title, day).filter(F.col(day) >= since)


def rolling_averages(df: DataFrame, title: list[str] = TITLE, day: str = "extraction_date") -> DataFrame:
    """7-row popularity and vote count, and 30-calendar-day vote average.

    The 7-row frames and the 30-day range order by the same day number, so all
    six aggregates come out of one shuffle and one sort.
    """
    ordered = Window.partitionBy(*title).orderBy("_day")
    week, month = ordered.rowsBetween(-6, Window.currentRow), ordered.rangeBetween(-29, Window.currentRow)
    units = df.withColumns(
        {"_day": epoch_day(day), "_popularity": fixed("popularity"), "_vote_average": fixed("vote_average")}
    )
    summed = units.withColumns(
        {
            "_popularity_sum": F.sum("_popularity").over(week),
            "rolling_7d_data_points": F.count("_popularity").over(week),
            "_votes_sum": F.sum("vote_count").over(week),
            "_votes_rows": F.count("vote_count").over(week),
            "_average_sum": F.sum("_vote_average").over(month),
            "rolling_30d_data_points": F.count("_vote_average").over(month),
        }
    )
    return summed.withColumns(
        {
            "rolling_7d_avg_popularity": mean("_popularity_sum", "rolling_7d_data_points", 4),
            "rolling_30d_avg_vote_average": mean("_average_sum", "rolling_30d_data_points", 4),
            "rolling_7d_avg_vote_count": mean("_votes_sum", "_votes_rows", 2),
        }
    ).drop("_day", "_popularity", "_vote_average", "_popularity_sum", "_votes_sum", "_votes_rows", "_average_sum")
