"""Registered queries over the given tables, each with its DuckDB counterpart."""

from workload import (  # noqa: F401
    expansion_queries,
    guard_queries,
    job_queries,
    landing_queries,
    metric_queries,
    publish_queries,
    reconcile_queries,
    scalar_queries,
    source_queries,
)
from workload.registry import ORACLES, QUERIES  # noqa: F401
