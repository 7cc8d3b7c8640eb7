"""The dead-letter table of a store: landed lines that are no rows, and where they lie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import path_exists

REJECT_SCHEMA = "dataset STRING, run_id STRING, item STRING, file STRING, block BIGINT, line BIGINT, reason STRING, raw STRING"


def rejects_path(store: str) -> str:
    return f"{store.rstrip('/')}/_rejects"


def store_rejects(lines: DataFrame, judged: DataFrame, store: str, run_id: str, dataset: str) -> None:
    """Keep the lines of ``judged`` that have a reason.

    A line is named by its file, the first byte of the file block it was read
    in, and its number in that block, from 0: blocks are read by different
    tasks, so nobody knows a line's number in the file. ``lines`` are all lines
    (file, block, row); rows of a block are numbered on from its first. A run
    that is started again replaces what it stored before.
    """
    first = lines.groupBy("file", "block").agg(F.min("row").alias("first"))
    found = judged.where("reason IS NOT NULL").join(first, ["file", "block"]).select(
        F.lit(dataset).alias("dataset"), F.lit(run_id).alias("run_id"), F.upper("symbol").alias("item"), "file", "block",
        (F.col("row") - F.col("first")).alias("line"), "reason", "raw",
    )
    writer = found.write.partitionBy("dataset", "run_id").option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(rejects_path(store))


def read_rejects(spark: SparkSession, store: str, run_id: str | None = None) -> DataFrame:
    """Rejected lines of a run, or of all."""
    path = rejects_path(store)
    if not path_exists(spark, path):
        return spark.createDataFrame([], REJECT_SCHEMA)
    rows = spark.read.schema(REJECT_SCHEMA).parquet(path)
    rows = rows if run_id is None else rows.where(F.col("run_id") == run_id)
    return rows.select(*[field.split()[0] for field in REJECT_SCHEMA.split(", ")])
