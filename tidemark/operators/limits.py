"""Sorting, first and last rows, repeatable samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import LISTING_PAGE


def sort_by_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Ascending by key, for a result; tenors sort as text."""
    return df.orderBy(*[F.col(f"`{k}`").asc() for k in keys])


def cluster_for_lookup(df: DataFrame, *columns: str) -> DataFrame:
    """Sort inside partitions, so file statistics can skip rows on a lookup."""
    return df.sortWithinPartitions(*columns)


def head(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.orderBy(*[F.col(f"`{k}`").asc() for k in keys]).limit(n)


def tail(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Last n rows, in ascending order."""
    last = df.orderBy(*[F.col(f"`{k}`").desc() for k in keys]).limit(n)
    return sort_by_keys(last, *keys)


def sample_rank(seed: int, *keys: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{k}`").cast("string") for k in keys]))


def sample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """Exactly min(n, rows) rows without replacement.

    The rank depends on seed and key only, so the sample is the same however
    the data is partitioned.
    """
    return df.orderBy(sample_rank(seed, *keys), *[F.col(f"`{k}`") for k in keys]).limit(n)


def paged_limit(limit: int, page: int = LISTING_PAGE) -> int:
    """``limit`` rounded up to whole pages."""
    return math.ceil(limit / page) * page
