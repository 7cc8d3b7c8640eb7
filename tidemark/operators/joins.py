"""Key lookups between what is asked for and what there is."""

from __future__ import annotations

from pyspark.sql import DataFrame


def requested_vs_available(
    requested: DataFrame, available: DataFrame, on: str | list[str]
) -> tuple[DataFrame, DataFrame]:
    """The requested keys that exist, and those that do not."""
    return requested.join(available, on, "left_semi"), requested.join(available, on, "left_anti")
