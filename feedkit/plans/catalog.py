"""All registered queries. Importing a module registers its queries."""

from feedkit.plans import (  # noqa: F401
    aggregate_queries,
    column_queries,
    join_queries,
    name_queries,
    order_queries,
    quality_queries,
    source_queries,
    stats_queries,
    update_queries,
)
from feedkit.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
