"""Fetch state, run and task reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_SCHEMA = "source STRING, dataset STRING, symbol STRING, status STRING, timestamp STRING"
LEDGER_SCHEMA = "run_id STRING, dataset STRING, item STRING, status STRING, reason STRING"
# What became of one item of a run: rows landed, taken (from the start date on), kept (stored rows that
# are new or changed), replaced (stored rows that went for them) and rejected before they were rows.
OUTCOME_COUNTS = ("landed", "taken", "kept", "replaced", "rejected")
OUTCOME_SCHEMA = (
    f"{LEDGER_SCHEMA}, {', '.join(f'{c} BIGINT' for c in OUTCOME_COUNTS)}, attempt STRING, written_at TIMESTAMP"
)
TASK_SCHEMA = (
    "run_id STRING, task STRING, status STRING, started_at TIMESTAMP, "
    "finished_at TIMESTAMP, error STRING"
)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The status log; lines that are no JSON are skipped."""
    return (
        spark.read.schema(STATE_SCHEMA)
        .option("mode", "DROPMALFORMED")
        .json(path)
        .withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    )


def append_state(records: DataFrame, path: str) -> None:
    """Append status records as JSON lines."""
    text = records.withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )
    text.select("source", "dataset", "symbol", "status", "timestamp").write.mode("append").json(path)


def reset_state(spark: SparkSession, path: str) -> None:
    """Clear the log."""
    spark.createDataFrame([], STATE_SCHEMA).write.mode("overwrite").json(path)


def last_status(
    state: DataFrame,
    keys: tuple[str, ...] = ("source", "dataset", "symbol"),
    order: tuple[str, ...] = ("timestamp",),
) -> DataFrame:
    """The newest record per key; more order columns break ties.

    Every map task keeps one record per key before the shuffle, so a symbol
    with very many records stays cheap.
    """
    rest = [c for c in state.columns if c not in keys]
    newest = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order]))
    return state.groupBy(*keys).agg(newest.alias("__newest")).select(
        *keys, *[F.col(f"__newest.{c}").alias(c) for c in rest]
    )


def failed_symbols(
    state: DataFrame,
    source: str | None = None,
    dataset: str | None = None,
    order: tuple[str, ...] = ("timestamp",),
    failed: str = "failed",
) -> DataFrame:
    """Symbols whose newest status is the failed one."""
    if source is not None:
        state = state.where(F.col("source") == source)
    if dataset is not None:
        state = state.where(F.col("dataset") == dataset)
    return last_status(state, order=order).where(F.col("status") == failed).select("symbol")


def item_outcomes(parts: DataFrame) -> DataFrame:
    """One row per item with its status and reason, from partial counts of it.

    ``parts`` has ``item``, ``spelled`` (the item as its stored rows have it), the counts of
    ``OUTCOME_COUNTS``, ``batch`` (rows of the batch), ``failed`` (the gate's reason) and ``problem``
    (why a landed line is no row); all but the item may be null or absent. An item is saved only if the
    store changed for it.
    """
    absent = [c for c in ("batch", *OUTCOME_COUNTS) if c not in parts.columns]
    parts = parts.withColumns({c: F.lit(None).cast("bigint") for c in absent})
    absent = [c for c in ("spelled", "failed", "problem") if c not in parts.columns]
    parts = parts.withColumns({c: F.lit(None).cast("string") for c in absent})
    counts = {c: F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("batch", *OUTCOME_COUNTS)}
    counts["landed"] = F.coalesce(F.sum("landed"), F.sum("batch"), F.lit(0)).alias("landed")
    texts = [F.min(c).alias(c) for c in ("spelled", "failed", "problem")]
    whole = parts.groupBy(F.col("item").alias("__key")).agg(*counts.values(), *texts)
    problem = F.col("problem").isNotNull() & (F.col("batch") == 0)
    status = (
        F.when(F.col("failed").isNotNull(), "failed").when(F.col("kept") > 0, "saved").when(problem, "failed").otherwise("skipped")
    )
    reason = (
        F.when(F.col("failed").isNotNull(), F.col("failed"))
        .when(F.col("kept") > 0, F.lit(None))
        .when(F.col("taken") > 0, "nothing new")
        .when(F.col("batch") > 0, "before the start date")
        .otherwise(F.coalesce("problem", F.lit("no rows")))
    )
    return whole.select(
        F.coalesce("spelled", "__key").alias("item"), status.alias("status"), reason.alias("reason"), *OUTCOME_COUNTS
    )


def run_report(ledger: DataFrame) -> DataFrame:
    """Per run: ok, total, saved, failed, skipped. The items themselves stay rows of the ledger."""
    return (
        ledger.groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("total"),
            *[
                F.count_if(F.col("status") == status).alias(status)
                for status in ("saved", "failed", "skipped")
            ],
        )
        .withColumn("ok", F.col("failed") == 0)
    )


def run_items(ledger: DataFrame, status: str) -> DataFrame:
    """Items of a run with the given status, and why, one row each."""
    return ledger.where(F.col("status") == status).select("run_id", "dataset", "item", "reason")


def task_report(task_log: DataFrame) -> DataFrame:
    """Per run: tasks run and failed, ok, start, end and duration in seconds."""
    return (
        task_log.groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("tasks_run"),
            F.count_if(F.col("status") == "failed").alias("tasks_failed"),
            F.min("started_at").alias("start_time"),
            F.max(F.coalesce("finished_at", "started_at")).alias("end_time"),
        )
        .withColumn("ok", F.col("tasks_failed") == 0)
        .withColumn(
            "duration_seconds",
            (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp")))
            / 1e6,
        )
    )
