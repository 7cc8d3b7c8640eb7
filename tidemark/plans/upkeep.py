"""Retention and compaction of stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import TABLES, TableSpec
from tidemark.plans.rollup import add_months
from tidemark.sinks.published import PublishedTable, bucket_day, bucket_start


def retained(df: DataFrame, date_column: str, months: int, now: dt.date) -> DataFrame:
    """Rows not older than ``months`` before ``now``."""
    return df.where(F.col(date_column).cast("date") >= F.lit(add_months(now, -months)))


def retain(table: PublishedTable, months: int, now: dt.date) -> int:
    """Drop what is older than ``months``. Returns the rows that stay.

    Buckets that are wholly older leave the manifest without being read; only
    the bucket the limit falls into is rewritten.
    """
    dataset, base = table.dataset, table.manifest()
    limit = add_months(now, -months)
    edge = bucket_start(dataset.bucket_width, limit)
    days = {n: bucket_day(n) for n in base.buckets}
    old = [n for n, day in days.items() if day is not None and day < edge]
    cut = [n for n, day in days.items() if day == edge and edge < limit]
    rows = table.read(manifest=base, keep=lambda b: b == edge.isoformat())
    if cut:
        expired = F.col(dataset.date_column).cast("date") < F.lit(limit)
        cut = [] if rows.where(expired).isEmpty() else cut
    if not old and not cut:
        return base.rows
    folder, counts = None, {}
    if cut:
        folder = table.stage(retained(rows, dataset.date_column, months, now))
        counts = table.staged_counts(folder, base.schema)
    return table.commit(base, folder, counts, base.schema, drop=old + cut).rows


def compact(
    table: PublishedTable,
    older_than: dt.date,
    segment_by: tuple[str, ...],
    order_by: tuple[str, ...] = (),
) -> list[str]:
    """Rewrite buckets that end before ``older_than``, clustered by segment.

    Rows are range-partitioned by bucket, segment and order, so a segment with
    a large share of the rows is spread over many files. A bucket is compacted
    once; it is due again only after a later write. Returns the buckets.
    """
    base = table.manifest()
    limit = bucket_start(table.dataset.bucket_width, older_than)
    due = [
        n
        for n, entry in base.buckets.items()
        if not entry.get("compacted") and bucket_day(n) is not None and bucket_day(n) < limit
    ]
    if not due:
        return []
    wanted = {bucket_day(n).isoformat() for n in due}
    rows = table.read(manifest=base, keep=lambda b: b in wanted)
    tail = order_by or (table.dataset.date_column,)
    folder = table.stage(rows, order=(*segment_by, *tail), dense=True)
    counts = table.staged_counts(folder, base.schema)
    table.commit(base, folder, counts, base.schema, drop=due, compacted=True)
    return sorted(wanted)


def compact_limit(spec: TableSpec, now: dt.date) -> dt.date:
    """Buckets that end before this day are compacted."""
    if spec.compact_unit == "days":
        return now - dt.timedelta(days=spec.compact_after)
    return add_months(now, -spec.compact_after)


def apply_policies(spark: SparkSession, store: str, now: dt.date) -> DataFrame:
    """Retention, then compaction, of every stored table that has a policy; unused folders go."""
    out = []
    for spec in TABLES.values():
        table = PublishedTable(spark, store, spec.dataset())
        if spec.bucket_width is None or not table.exists():
            continue
        before = table.manifest().rows
        after = retain(table, spec.retain_months, now) if spec.retain_months else before
        done = (
            compact(table, compact_limit(spec, now), spec.segment_by, spec.order_by)
            if spec.compact_after
            else []
        )
        table.expire_versions()
        out.append((spec.name, before - after, len(done)))
    return spark.createDataFrame(out, "table STRING, dropped_rows BIGINT, compacted_buckets INT")
