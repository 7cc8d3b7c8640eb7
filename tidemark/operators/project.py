"""Column and row selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import days_before


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def with_audit(df: DataFrame, source: str, batch_ts: dt.datetime | str, **constants) -> DataFrame:
    """Add ``source``, ``last_fetched_at`` and other constants, the same for the whole batch."""
    columns = {name: F.lit(value) for name, value in constants.items()}
    columns["source"] = F.lit(source)
    columns["last_fetched_at"] = F.lit(batch_ts).cast("timestamp")
    return df.withColumns(columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ("date",)) -> DataFrame:
    """Put ``prefix`` before every column name but those in ``keep``."""
    kept = set(keep)
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in kept})


def conform(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Columns of ``schema`` in its order and types; missing ones are null.

    ``lenient`` turns values that do not fit the type into null.
    """
    have = set(df.columns)
    out = []
    for f in schema:
        if f.name not in have:
            value = F.lit(None).cast(f.dataType)
        elif lenient:
            value = _name(f.name).try_cast(f.dataType)
        else:
            value = _name(f.name).cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, but the declared columns."""
    return spark.createDataFrame([], schema)


def intersect_columns(df: DataFrame, target: Iterable[str]) -> DataFrame:
    """The target columns that exist, in target order."""
    have = set(df.columns)
    return df.select(*[_name(c) for c in target if c in have])


def drop_null_obs(df: DataFrame, columns: Iterable[str] = ("date", "value")) -> DataFrame:
    return df.dropna(subset=list(columns))


def between_dates(
    df: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    column: str = "date",
) -> DataFrame:
    """Rows from ``start`` to ``end``, both included, each bound optional."""
    if start is not None:
        df = df.where(_name(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(_name(column) <= F.lit(end).cast("date"))
    return df


def max_date(df: DataFrame, column: str = "date") -> DataFrame:
    """One row with the latest date; null when there are no rows."""
    return df.agg(F.max(_name(column)).alias("max_date"))


def incremental_start(
    existing: DataFrame, lookback_days: int, column: str = "date", monthly: bool = False
) -> DataFrame:
    """One row with the first date to fetch again; null means full history."""
    start = days_before("max_date", lookback_days)
    if monthly:
        start = F.trunc(start, "month")
    return max_date(existing, column).select(start.cast("date").alias("start_date"))


def incremental_start_by(
    existing: DataFrame, item: str, lookback_days: int, column: str = "date", monthly: bool = False
) -> DataFrame:
    """``incremental_start`` for every country or ticker at once."""
    start = days_before(F.max(_name(column)), lookback_days)
    start = F.trunc(start, "month") if monthly else start
    return existing.groupBy(item).agg(start.alias("start_date"))


def incremental_since(
    existing: DataFrame,
    new: DataFrame,
    lookback_days: int,
    column: str = "date",
    monthly: bool = False,
) -> DataFrame:
    """New rows from the start date on; all of them when there is no stored data.

    The start is one aggregated row, so it reaches the scan of ``new`` as a
    literal that can be pushed down.
    """
    start = incremental_start(existing, lookback_days, column, monthly).first()["start_date"]
    return between_dates(new, start=start, column=column)


def incremental_since_by(
    existing: DataFrame,
    new: DataFrame,
    item: str,
    lookback_days: int,
    column: str = "date",
    monthly: bool = False,
) -> DataFrame:
    """New rows from each item's own start date on; unknown items are taken whole."""
    starts = incremental_start_by(existing, item, lookback_days, column, monthly)
    return (
        new.join(starts, item, "left")
        .where(F.col("start_date").isNull() | (_name(column) >= F.col("start_date")))
        .drop("start_date")
    )


def select_series(
    df: DataFrame, names: str | Iterable[str], column: str, known: Iterable[str] | None = None
) -> DataFrame:
    """Rows of the named series: "ALL", one name or several.

    ``known`` lists the valid names; "ALL" then means those, and an unknown
    name is an error.
    """
    allowed = list(known) if known is not None else None
    if isinstance(names, str) and names == "ALL":
        return df if allowed is None else df.where(_name(column).isin(allowed))
    wanted = [names] if isinstance(names, str) else list(names)
    unknown = [n for n in wanted if allowed is not None and n not in allowed]
    if unknown:
        raise KeyError(f"unknown series: {unknown}")
    return df.where(_name(column).isin(wanted))


def dimension_filter(df: DataFrame, filters: Mapping[str, str | Iterable[str]]) -> DataFrame:
    """Rows that match every dimension; a list of codes matches any of them."""
    for dimension, wanted in filters.items():
        column = _name(dimension)
        df = df.where(
            column == F.lit(wanted) if isinstance(wanted, str) else column.isin(list(wanted))
        )
    return df


def read_by_key(df: DataFrame, column: str, key: str) -> DataFrame:
    """Rows of one ticker, country or market; the key is case-normalised."""
    return df.where(_name(column) == F.lit(key.upper()))
