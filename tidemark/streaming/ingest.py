"""Landed files as a stream, merged into a stored dataset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.catalog import Dataset
from tidemark.plans.save import save_dataset


def landed_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    file_format: str = "json",
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a landing folder as a stream."""
    reader = spark.readStream.schema(schema).format(file_format)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def merge_stream(
    stream: DataFrame,
    store: str,
    dataset: Dataset,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Merge every micro-batch so that the newest fetch of a key wins.

    A batch that is replayed after a failure merges to the same rows, because
    the merge is by key.
    """

    def merge_batch(batch: DataFrame, _batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        outcome = save_dataset(batch.sparkSession, store, dataset, rows)
        if outcome.status == "failed":
            raise RuntimeError(f"{dataset.name}: {outcome.reason}")

    writer = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
