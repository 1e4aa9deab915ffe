"""The operators applied to the driver's tables, each with the same question in plain SQL."""

from workload import cleaning, landings, models, prices, scores, screens  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
