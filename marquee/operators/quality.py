"""Quality gates. Every gate is one pass of conditional counts, however many rules it has."""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.contracts import REQUIRED, REQUIRED_IN_RECORD, SCORE_RANGE


class QualityError(ValueError):
    """A gate that must hold does not."""


def require_columns(df: DataFrame, media: str) -> None:
    missing = sorted(set(REQUIRED.get(media, [])) - set(df.columns))
    if missing:
        raise QualityError(f"{media}: missing columns {missing}, have {sorted(df.columns)}")


def require_fields(census: DataFrame, media: str) -> None:
    """Fail if a required field is named by no record, as a fixed schema would read it as null everywhere."""
    named = {r["field"] for r in census.filter(F.col("field").isin(REQUIRED.get(media, []))).collect()}
    missing = sorted(set(REQUIRED.get(media, [])) - named)
    if missing:
        raise QualityError(f"{media}: no record names {missing}")


def require_values(df: DataFrame, media: str) -> None:
    """Fail if no record at all carries a required field.

    Under a fixed schema a field the feed dropped reads as null everywhere. The
    first complete record settles it; only a feed without one is counted through.
    """
    required = REQUIRED.get(media, [])
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in required], F.lit(True))
    if not df.filter(complete).isEmpty():
        return
    present = _one_row(df.agg(*[F.count(name).alias(name) for name in required]))
    missing = sorted(name for name, values in present.items() if not values)
    if missing:
        raise QualityError(f"{media}: no record has {missing}")


def _one_row(df: DataFrame) -> dict[str, Any]:
    return df.first().asDict()


def batch_is_valid(df: DataFrame, required: list[str] = REQUIRED_IN_RECORD) -> bool:
    """True for a non-empty batch in which no record lacks a required field."""
    if not set(required) <= set(df.columns):
        return False
    counts = _one_row(missing_fields(df, required))
    return counts.pop("records") > 0 and not any(counts.values())


def missing_fields(df: DataFrame, required: list[str]) -> DataFrame:
    counts = [F.count_if(F.col(name).isNull()).alias(f"missing_{name}") for name in required]
    return df.agg(F.count("*").alias("records"), *counts)


def score_flag(score: Column | str = "vote_average") -> Column:
    """Whether a score is in range; null for no score."""
    score = F.col(score) if isinstance(score, str) else score
    return score.between(*SCORE_RANGE)


def flag_scores(df: DataFrame) -> DataFrame:
    return df.withColumn("_dq_vote_avg_valid", score_flag()) if "vote_average" in df.columns else df


def violations(df: DataFrame) -> DataFrame:
    """One row: records, null ids, scores out of range, negative popularities."""
    counts = [F.count("*").alias("records"), F.count_if(F.col("id").isNull()).alias("null_ids")]
    if "vote_average" in df.columns:
        counts.append(F.count_if(~score_flag()).alias("scores_out_of_range"))
    if "popularity" in df.columns:
        counts.append(F.count_if(F.col("popularity") < 0).alias("negative_popularity"))
    return df.agg(*counts)


def require_ids(counts: dict[str, Any], label: str) -> None:
    if counts["null_ids"]:
        raise QualityError(f"{label}: {counts['null_ids']} of {counts['records']} records have no id")


# What a bound of a rule is called in the result, and which values break it.
BOUNDS: dict[str, tuple[str, Callable[[Column, Any], Column]]] = {
    "min": ("below_min", operator.lt),
    "max": ("above_max", operator.gt),
}


def rule_counts(df: DataFrame, checks: dict[str, dict[str, Any]]) -> DataFrame | None:
    """Rows below `min` and above `max` per column; columns the table lacks are left out."""
    bounds = [(name, bound, limit) for name in df.columns if name in checks for bound, limit in checks[name].items()]
    counts = [F.count_if(BOUNDS[b][1](F.col(n), limit)).alias(f"{n}_{BOUNDS[b][0]}") for n, b, limit in bounds if b in BOUNDS]
    return df.agg(*counts) if counts else None


def passes(df: DataFrame, checks: dict[str, dict[str, Any]]) -> bool:
    counted = rule_counts(df, checks)
    return counted is None or not any(_one_row(counted).values())


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose foreign key is set but has no parent."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row: how many child rows have no parent. Rows are counted by key first, so a hot key joins as one row."""
    counted = child.groupBy(column).agg(F.count("*").alias("_rows"))
    lost = orphans(counted, column, parent, parent_column)
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint")).alias("orphans"))


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def require_unique(df: DataFrame, key: list[str], label: str) -> None:
    first = repeated_keys(df, key).first()
    if first is not None:
        raise QualityError(f"{label}: key {key} repeats, e.g. {first.asDict()}")


def load_counts(fact: DataFrame, movies: DataFrame, genres: DataFrame, day: Column) -> DataFrame:
    """One row: facts of the day, titles, genres."""
    facts = fact.filter(F.col("date") == day).agg(F.count("*").alias("facts"))
    return facts.select(
        "facts",
        movies.agg(F.count("*")).scalar().alias("movies"),
        genres.agg(F.count("*")).scalar().alias("genres"),
    )


def require_load(counts: dict[str, Any]) -> None:
    if not counts["facts"]:
        raise QualityError("no facts loaded for the day")


def export_status(expected: int, actual: int) -> str:
    """The target may hold more rows than were sent, from earlier runs."""
    return "PASSED" if actual >= expected else "FAILED"


def overall_status(exports: list[dict[str, Any]], checks: list[dict[str, Any]]) -> str:
    good = all(e["status"] == "SUCCESS" for e in exports) and all(c["status"] == "PASSED" for c in checks)
    return "success" if good else "partial_failure"
