"""Tidemark: keyed financial time series on Spark.

Landed vendor files are shaped into tidy tables, merged so that the newest
fetch of every key wins, gated, published as versioned Parquet, rolled up and
profiled. Everything is expressed with the DataFrame API.
"""

from tidemark.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
