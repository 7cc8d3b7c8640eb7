"""The run ledger of a store: what became of every item, true to what was committed.

Outcomes are written before the commit they belong to and name its attempt, the
staged folder; the commit names the attempt too. A reader counts an attempt
only if its commit is there. So a job that dies in between leaves neither data
nor ledger rows, and a run that is started again under its id counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.ledger import LEDGER_SCHEMA, OUTCOME_COUNTS, OUTCOME_SCHEMA
from tidemark.sinks.published import read_lineage
from tidemark.sources.files import path_exists

_LEDGER_COLUMNS = [field.split()[0] for field in LEDGER_SCHEMA.split(", ")]


def ledger_path(store: str) -> str:
    return f"{store.rstrip('/')}/_run_ledger"


def record(outcomes: DataFrame, store: str, run_id: str, dataset: str, attempt: str | None = None) -> None:
    """Add outcomes (item, status, reason and, where known, counts) of one run to the ledger."""
    counts = [(F.col(c) if c in outcomes.columns else F.lit(None)).cast("bigint").alias(c) for c in OUTCOME_COUNTS]
    rows = outcomes.select(
        F.lit(run_id).alias("run_id"), F.lit(dataset).alias("dataset"), F.col("item").cast("string").alias("item"),
        "status", F.col("reason").cast("string").alias("reason"), *counts,
        F.lit(attempt).cast("string").alias("attempt"), F.current_timestamp().alias("written_at"),
    )
    rows.write.mode("append").parquet(ledger_path(store))


def read_outcomes(spark: SparkSession, store: str, run_id: str | None = None) -> DataFrame:
    """Outcomes of a run, or of all: those of committed attempts, the newest one of each item."""
    path = ledger_path(store)
    if not path_exists(spark, path):
        return spark.createDataFrame([], OUTCOME_SCHEMA)
    rows = spark.read.schema(OUTCOME_SCHEMA).parquet(path)
    if run_id is not None:
        rows = rows.where(F.col("run_id") == run_id)
    # Of the datasets that have attempts, those that were ever published.
    names = [r["dataset"] for r in rows.where("attempt IS NOT NULL").select("dataset").distinct().collect()]
    known = [n for n in names if path_exists(spark, f"{store.rstrip('/')}/{n}/manifests")]
    free = rows.where("attempt IS NULL")
    if known:
        done = read_lineage(spark, store, known).select(F.col("extra")["attempt"].alias("attempt"))
        free = free.unionByName(rows.join(done.where("attempt IS NOT NULL"), "attempt", "left_semi"))
    newest = Window.partitionBy("run_id", "dataset", F.upper("item")).orderBy(F.desc("written_at"), "attempt")
    return free.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank")


def read_ledger(spark: SparkSession, store: str, run_id: str | None = None) -> DataFrame:
    """The ledger rows of a run, or of all runs."""
    return read_outcomes(spark, store, run_id).select(*_LEDGER_COLUMNS)
