"""All registered queries."""

from __future__ import annotations

from cardwatch.plans import (  # noqa: F401
    filter_queries,
    label_queries,
    metric_queries,
    model_queries,
    source_queries,
    window_queries,
)
from cardwatch.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
