"""Named queries over the test tables, each with the SQL that gives the same answer.

Importing this package fills the registry.
"""

from wattloom.catalog import (  # noqa: F401
    aggregate_queries,
    column_queries,
    filter_queries,
    function_queries,
    job_queries,
    join_queries,
    model_queries,
    model_steps,
    order_queries,
    source_queries,
    window_queries,
)
from wattloom.catalog.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
