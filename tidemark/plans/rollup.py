"""Stored rollups and their incremental refresh."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog import NOT_EMPTY, TABLES, Dataset
from tidemark.functions import time_bucket
from tidemark.operators.aggregate import ROLLUPS, Rollup, roll_up
from tidemark.plans.invalidation import behind, note, overlapping
from tidemark.sinks.published import PublishedTable, bucket_day, bucket_start


def add_months(day: dt.date, months: int) -> dt.date:
    """Calendar shift; a day past the end of the month becomes its last day."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    first = dt.date(year, month + 1, 1)
    following = dt.date(year + month // 11, (month + 1) % 12 + 1, 1)
    return first.replace(day=min(day.day, (following - first).days))


def refresh_window(rollup: Rollup, now: dt.date, width: str | None = None) -> tuple[dt.date, dt.date]:
    """First bucket to refresh and first bucket not to: whole buckets inside
    [now - start offset, now - end offset)."""
    width = width or rollup.width
    months = {"day": 0, "month": 1, "quarter": 3, "year": 12}[width]
    low = add_months(now, -rollup.start_months)
    high = now - dt.timedelta(days=rollup.end_days)
    first = bucket_start(width, low)
    if first < low:
        first = add_months(first, months) if months else first + dt.timedelta(days=1)
    return first, bucket_start(width, high)


def window_rows(df: DataFrame, rollup: Rollup, now: dt.date) -> DataFrame:
    """Base rows of the buckets to refresh; the bounds reach the scan as literals."""
    first, end = refresh_window(rollup, now)
    date = F.col(rollup.date_column).cast("date")
    return df.where((date >= F.lit(first)) & (date < F.lit(end)))


def rollup_dataset(rollup: Rollup, schema: T.StructType) -> Dataset:
    """Stored form of a rollup: one folder per bucket."""
    return Dataset(
        rollup.name,
        schema,
        keys=("bucket_start", *rollup.group_by),
        gate=NOT_EMPTY,
        date_column="bucket_start",
        bucket_width=rollup.width,
        cluster_by=rollup.group_by,
    )


def _stored_form(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("bucket", "bucket_start")


def _base(spark: SparkSession, store: str, rollup: Rollup) -> PublishedTable:
    return PublishedTable(spark, store, TABLES[rollup.base].dataset())


def build_rollup(spark: SparkSession, store: str, name: str) -> int:
    """Full rebuild of a rollup. Returns its rows."""
    rollup = ROLLUPS[name]
    base = _base(spark, store, rollup)
    seen = base.manifest()
    rows = _stored_form(roll_up(base.read(manifest=seen), rollup))
    table = PublishedTable(spark, store, rollup_dataset(rollup, rows.schema))
    return table.replace(rows, note(seen, ())).rows


def refresh_rollup(spark: SparkSession, store: str, name: str, now: dt.date) -> int:
    """Recompute the buckets of the refresh window; all other buckets stay untouched.

    Only base buckets that overlap the window are read. A bucket of the window
    without base rows any more is removed. Returns the rows written.
    """
    rollup = ROLLUPS[name]
    first, end = refresh_window(rollup, now)
    base = _base(spark, store, rollup)
    seen = base.manifest()
    left = {d for d in behind(_probe(spark, store, rollup), base, seen, rollup) if not first <= d < end}
    source = base.read_dates(first, end - dt.timedelta(days=1))
    rows = _stored_form(roll_up(source, rollup))
    table = PublishedTable(spark, store, rollup_dataset(rollup, rows.schema))
    manifest = table.manifest()
    folder = table.stage(rows)
    counts = table.staged_counts(folder, rows.schema)
    days = {n: bucket_day(n) for n in manifest.buckets}
    in_window = [n for n, day in days.items() if day is not None and first <= day < end]
    table.commit(manifest, folder, counts, rows.schema, drop=in_window, extra=note(seen, left))
    return sum(counts.values())


def refresh_changed(spark: SparkSession, store: str, name: str, now: dt.date) -> list[dt.date]:
    """Recompute the buckets of the refresh window whose base rows changed since they were computed.

    Only base buckets that overlap these are read; where nothing changed,
    nothing is read or published. Changed buckets outside the window stay
    noted until a later window holds them. Returns the buckets recomputed.
    """
    rollup = ROLLUPS[name]
    first, end = refresh_window(rollup, now)
    base = _base(spark, store, rollup)
    seen = base.manifest()
    due = behind(_probe(spark, store, rollup), base, seen, rollup)
    todo = {d for d in due if first <= d < end}
    if not todo:
        return []

    def wanted(bucket: str | None) -> bool:
        if bucket is None:
            return False
        return bool(todo & overlapping(base.dataset.bucket_width, dt.date.fromisoformat(bucket), rollup.width))

    days = sorted(todo)
    source = base.read(manifest=seen, keep=wanted)
    rows = _stored_form(roll_up(source.where(time_bucket(rollup.width, rollup.date_column).isin(days)), rollup))
    table = PublishedTable(spark, store, rollup_dataset(rollup, rows.schema))
    manifest = table.manifest()
    folder = table.stage(rows)
    counts = table.staged_counts(folder, rows.schema)
    gone = [n for n in manifest.buckets if bucket_day(n) in todo]
    table.commit(manifest, folder, counts, rows.schema, drop=gone, extra=note(seen, due - todo))
    return days


def refresh_all_changed(spark: SparkSession, store: str, now: dt.date) -> DataFrame:
    """``refresh_changed`` of every rollup whose base is stored: rollup, refreshed_buckets."""
    out = [
        (name, len(refresh_changed(spark, store, name, now)))
        for name, rollup in ROLLUPS.items()
        if _base(spark, store, rollup).exists()
    ]
    return spark.createDataFrame(out, "rollup STRING, refreshed_buckets INT")


def _probe(spark: SparkSession, store: str, rollup: Rollup) -> PublishedTable:
    return PublishedTable(spark, store, rollup_dataset(rollup, T.StructType([])))


def read_rollup(spark: SparkSession, store: str, name: str) -> DataFrame:
    return _probe(spark, store, ROLLUPS[name]).read().withColumnRenamed("bucket_start", "bucket")

