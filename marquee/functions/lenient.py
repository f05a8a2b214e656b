"""Parsing that turns bad input into null or a default instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_number(value: Column | str, kind: str = "double") -> Column:
    """Number from text; a whole number may be written as '10.0' or '1e3'."""
    value = F.col(value) if isinstance(value, str) else value
    text = F.trim(value.cast("string"))
    real = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    return real if kind == "double" else F.coalesce(text.try_cast(kind), real.try_cast(kind))


def number_or_zero(value: Column | str, kind: str = "double") -> Column:
    return F.coalesce(lenient_number(value, kind), F.lit(0).cast(kind))


def lenient_date(value: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(F.col(value) if isinstance(value, str) else value, F.lit(fmt)).cast("date")


def text_or_empty(value: Column | str) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(""))


def first_text(*values: str) -> Column:
    """First non-null of several text columns, else empty."""
    return F.coalesce(*[F.col(v) for v in values], F.lit(""))


def blank_to_null(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.nullif(value, F.lit(""))
