"""The operators applied to whole driver tables, each with its SQL counterpart.

The driver tables are not financial, so small adapters give their columns the
roles of tickers, series, dates and values. Money is read in whole cents, so
sums are exact whatever order they are formed in. Dates are shown as ISO text.
"""

from tidemark.workload import jobs, quality, reshaping, rollups, scalars, sources, stored
from tidemark.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "jobs", "quality", "reshaping", "rollups", "scalars", "sources", "stored"]
