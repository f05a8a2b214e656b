"""Jobs, and the registered queries over the supplied tables."""

from marquee.plans import cleaning_queries, serving_queries, table_queries, trend_queries  # noqa: F401
from marquee.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
