"""Rollups kept up to date by a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.catalog import Dataset
from tidemark.functions import time_bucket
from tidemark.operators.aggregate import ROLLUPS, roll_up
from tidemark.operators.quality import GateError
from tidemark.plans.rollup import rollup_dataset
from tidemark.plans.save import save_dataset
from tidemark.sinks.published import PublishedTable, bucket_start


def bucket_stream(
    stream: DataFrame,
    time_column: str,
    keys: list[str],
    measures: list[Column],
    store: str,
    dataset: Dataset,
    checkpoint: str,
    width: str = "1 day",
    lateness: str = "1 day",
    available_now: bool = True,
) -> StreamingQuery:
    """Tumbling aggregates of fixed width; rows later than ``lateness`` are dropped.

    Updated buckets are merged by key, so a replayed batch changes nothing. A
    batch that fails the gate stops the stream; its offsets are not committed.
    State holds the open buckets only, never the rows.
    """
    buckets = (
        stream.withWatermark(time_column, lateness)
        .groupBy(F.window(time_column, width).alias("window"), *keys)
        .agg(*measures)
        .withColumn("bucket_start", F.col("window.start").cast("date"))
        .drop("window")
    )

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        # The time of the update orders them, also across checkpoints.
        rows = batch.withColumn("last_fetched_at", F.lit(dt.datetime.now(dt.timezone.utc)))
        outcome = save_dataset(batch.sparkSession, store, dataset, rows)
        if outcome.status == "failed":
            raise GateError(f"batch {batch_id}: {outcome.reason}")

    writer = (
        buckets.writeStream.outputMode("update")
        .foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def refresh_touched(base: PublishedTable, batch: DataFrame, rollup_name: str) -> list[dt.date]:
    """Recompute the calendar buckets a batch touched, from the base table.

    Windows of a stream have no calendar width, so months and quarters are
    refreshed this way, from ``foreachBatch``, after the batch is merged. The
    number of buckets is bounded by the calendar.
    """
    rollup = ROLLUPS[rollup_name]
    touched = sorted(
        r[0]
        for r in batch.select(time_bucket(rollup.width, rollup.date_column))
        .where(F.col(rollup.date_column).isNotNull())
        .distinct()
        .collect()
    )
    if not touched:
        return []
    wanted = set(touched)

    def holds_some(bucket: str | None) -> bool:
        """Whether a bucket of the base overlaps one of the rollup; either may be the wider."""
        if bucket is None or not base.dataset.time_bucketed:
            return bucket is not None
        day = dt.date.fromisoformat(bucket)
        inside = bucket_start(base.dataset.bucket_width, day) == day and bucket_start(rollup.width, day) in wanted
        return inside or any(bucket_start(base.dataset.bucket_width, start) == day for start in touched)

    rows = base.read(keep=holds_some).where(time_bucket(rollup.width, rollup.date_column).isin(touched))
    rolled = roll_up(rows, rollup).withColumnRenamed("bucket", "bucket_start")
    table = PublishedTable(base.spark, base.store, rollup_dataset(rollup, rolled.schema))
    manifest = table.manifest()
    folder = table.stage(rolled)
    counts = table.staged_counts(folder, rolled.schema)
    # What the rollup notes of its base stays: these buckets are merely done early.
    table.commit(manifest, folder, counts, rolled.schema, extra=table.extra())
    return touched
