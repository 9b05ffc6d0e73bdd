"""Checked queries: each operator on the shared test tables, beside the SQL it must agree with."""

from suite import daily_runs, scans, sinks, star, streams, transforms  # noqa: F401  (they register queries)
from suite.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
