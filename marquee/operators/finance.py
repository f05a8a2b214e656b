"""Return on investment per title, ranked and smoothed per genre."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.exact import fixed, mean, percent, ratio
from marquee.operators.keys import deduplicate
from marquee.operators.ranking import group_rank, moving_rows, value_ranks, with_ranks
from marquee.session import materialize

ROLLING_TITLES = 10


def with_missing_money(df: DataFrame) -> DataFrame:
    """Budget and revenue as null columns where a feed does not carry them."""
    absent = {name: F.lit(None).cast("double") for name in ("budget", "revenue") if name not in df.columns}
    return df.withColumns(absent) if absent else df


def has_finances(df: DataFrame) -> DataFrame:
    """Rows with a positive budget and a known revenue."""
    return df.filter((F.col("budget") > 0) & F.col("revenue").isNotNull())


def roi_ratio(budget: Column | str = "budget", revenue: Column | str = "revenue") -> Column:
    """(revenue - budget) / budget, 4 digits; null for a zero budget."""
    cost, income = fixed(budget), fixed(revenue)
    return ratio(income - cost, cost, 4)


def roi_pct(budget: Column | str = "budget", revenue: Column | str = "revenue", digits: int | None = 1) -> Column:
    """Return in percent, null unless the budget is positive; `digits=None` leaves it unrounded."""
    cost, income = (F.col(c) if isinstance(c, str) else c for c in (budget, revenue))
    if digits is None:
        return F.when(cost > 0, F.try_divide((income - cost).cast("double"), cost.cast("double")) * 100)
    return F.when(cost > 0, percent(fixed(income) - fixed(cost), fixed(cost), digits))


def profit_margin_pct(budget: Column | str = "budget", revenue: Column | str = "revenue") -> Column:
    """Profit in percent of revenue, 2 digits; null for zero revenue."""
    cost, income = fixed(budget), fixed(revenue)
    return percent(income - cost, income, 2)


def latest_per_title(df: DataFrame, title: list[str], day: str = "extraction_date") -> DataFrame:
    return deduplicate(df, title, [F.col(day)])


RANKING = [("roi", "desc")]


def priced_by_genre(df: DataFrame) -> DataFrame:
    """One row per title and genre with its return and margin, titles without finances left out."""
    known = has_finances(with_missing_money(df))
    priced = known.withColumns({"roi": roi_ratio(), "profit_margin_pct": profit_margin_pct()})
    return priced.withColumn("genre", F.explode_outer("genres"))


def roi_ranked(df: DataFrame) -> DataFrame:
    """One row per title and genre with its return and its rank in the genre."""
    return group_rank(priced_by_genre(df), ["genre"], RANKING, "rank", "roi_genre_rank")


def rolling_roi(priced: DataFrame) -> DataFrame:
    """Average return over the last 10 releases of the genre, ids breaking equal dates."""
    units = priced.withColumn("_roi", fixed("roi"))
    moved = moving_rows(
        units,
        ["genre"],
        [("release_date", "asc"), ("id", "asc")],
        ROLLING_TITLES - 1,
        {"_roi_sum": F.sum("_roi"), "_roi_rows": F.count("_roi")},
    )
    smoothed = mean("_roi_sum", "_roi_rows", 4)
    return moved.withColumn("rolling_avg_roi", smoothed).drop("_roi", "_roi_sum", "_roi_rows")


def roi_analysis(df: DataFrame, title: list[str] | None = None, day: str | None = "extraction_date") -> DataFrame:
    """Latest row of each title, ranked by return and smoothed per genre.

    Ranks and releases are counted from one table that is written once: deduplication, prices and genres are not made
    again for each of them.
    """
    newest = latest_per_title(df, title or ["id"], day) if day else df
    priced = materialize(priced_by_genre(newest), "priced")
    ranks = value_ranks(priced, ["genre"], RANKING, "rank")
    return with_ranks(rolling_roi(priced), ranks, ["genre"], RANKING, "roi_genre_rank")
