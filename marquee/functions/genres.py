"""Genre ids to names through a literal map: no join, no re-aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.contracts import GENRES


def genre_map() -> Column:
    pairs = [F.lit(part) for pair in sorted(GENRES.items()) for part in pair]
    return F.create_map(*pairs)


def empty_names() -> Column:
    return F.array().cast("array<string>")


def genre_names(ids: Column | str) -> Column:
    """Distinct names in alphabetical order; unknown ids drop out, no ids give an empty array."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    lookup = genre_map()
    names = F.transform(ids, lambda genre_id: F.try_element_at(lookup, genre_id))
    return F.coalesce(F.array_sort(F.array_distinct(F.array_compact(names))), empty_names())
