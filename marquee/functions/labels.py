"""Display labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks and class names shown to the user.
UP, DOWN, FLAT = "↑", "↓", "→"
UP_CLASS, DOWN_CLASS, FLAT_CLASS = "trend-up", "trend-down", "trend-neutral"
FULL_STAR, HALF_STAR, EMPTY_STAR = "★", "½", "☆"
NOT_AVAILABLE = "N/A"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _by_direction(change: Column | str, up: str, down: str, flat: str) -> Column:
    whole = _col(change).cast("bigint")
    return F.when(whole > 0, up).when(whole < 0, down).otherwise(flat)


def trend_arrow(change: Column | str) -> Column:
    return _by_direction(change, UP, DOWN, FLAT)


def trend_class(change: Column | str) -> Column:
    return _by_direction(change, UP_CLASS, DOWN_CLASS, FLAT_CLASS)


def _plain(value: Column, digits: int) -> Column:
    return F.translate(F.format_number(value, digits), ",", "")


def money_label(amount: Column | str, billions: bool = True) -> Column:
    """$1.2B / $160M / $12,345 / N/A; without `billions` the M form is the largest."""
    amount = _col(amount).cast("double")
    millions = F.concat(F.lit("$"), _plain(amount / 1e6, 0), F.lit("M"))
    label = F.when(amount >= 1e6, millions).when(amount > 0, F.concat(F.lit("$"), F.format_number(amount, 0)))
    if billions:
        label = F.when(amount >= 1e9, F.concat(F.lit("$"), _plain(amount / 1e9, 1), F.lit("B"))).otherwise(label)
    return F.coalesce(label, F.lit(NOT_AVAILABLE))


def thousands_label(value: Column | str) -> Column:
    return F.format_number(_col(value).cast("bigint"), 0)


def magnitude(value: Column | str) -> Column:
    return F.abs(_col(value).cast("bigint"))


def star_rating(score: Column | str) -> Column:
    """Five stars from a 0-10 score, halves allowed; no score is five empty ones."""
    stars = _col(score) / 2
    full = stars.cast("int")
    half = (stars - full >= 0.5).cast("int")
    drawn = F.concat(
        F.repeat(F.lit(FULL_STAR), full), F.repeat(F.lit(HALF_STAR), half), F.repeat(F.lit(EMPTY_STAR), 5 - full - half)
    )
    return F.coalesce(drawn, F.lit(EMPTY_STAR * 5))


def bubble_size(roi: Column | str) -> Column:
    """Chart marker size, kept between 8 and 30."""
    return F.least(F.greatest(F.abs(_col(roi)) / 10 + 8, F.lit(8.0)), F.lit(30.0))


def short_title(title: Column | str, length: int) -> Column:
    return F.substring(_col(title), 1, length)


def image_url(path: Column | str, base: str, size: str) -> Column:
    path = _col(path)
    return F.when(F.coalesce(path, F.lit("")) == "", "").otherwise(F.concat(F.lit(f"{base}/{size}"), path))
