"""Incremental saves: merge a batch into a stored dataset, gate it, publish it.

One code path serves every dataset. Only the buckets a batch touches are read,
merged and rewritten. The gate runs on what was written but not yet published,
so rows that fail are never seen by a reader.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.catalog import DATASETS, Dataset
from tidemark.operators.ledger import LEDGER_SCHEMA, item_outcomes
from tidemark.operators.merge import dedupe_grain, merge_latest, row_hash
from tidemark.operators.project import between_dates, incremental_start_by
from tidemark.operators.quality import (
    GateError,
    combined_metrics,
    failing_items,
    first_failure,
    gate_metrics,
    gate_report,
    gate_rows,
    missing_columns,
)
from tidemark.operators.union import align, merged_schema, relaxed_union
from tidemark.plans.marks import as_stored, move_marks, read_marks
from tidemark.plans.outcomes import read_ledger, record
from tidemark.session import scratch_root
from tidemark.sinks.published import BUCKET, Manifest, PublishedTable, bucket_folder, bucket_value

# Whether a row of a batch lies on or after its item's start date, and that date.
_TAKEN, _START = "__taken", "__start"


@dataclass(frozen=True)
class SaveOutcome:
    """What a save did: "saved", "skipped" (nothing new) or "failed" (gate)."""

    dataset: str
    status: str
    reason: str | None = None
    version: int | None = None
    rows: int | None = None


def touched_buckets(new: DataFrame, dataset: Dataset) -> set[str | None]:
    """Buckets of a batch; the calendar, or the list of countries or markets, bounds their number."""
    rows = new.select(dataset.bucket_expr().alias("bucket")).distinct().collect()
    return {r["bucket"] for r in rows}


def _stage_merged(
    table: PublishedTable, base: Manifest, new: DataFrame, touched: set[str | None]
) -> tuple[str, StructType]:
    """Merge a batch into the buckets it touches and write them; nothing is published yet."""
    stored = table.read(manifest=base, keep=touched.__contains__)
    merged = merge_latest(stored, new, table.dataset.keys)
    schema = merged_schema(base.schema, merged.schema)
    return table.stage(align(merged, schema)), schema


def _since_start(
    table: PublishedTable, new: DataFrame, lookback_days: int | None, monthly: bool
) -> DataFrame:
    if lookback_days is None or not table.exists():
        return new
    newest = table.max_date()
    if newest is None:
        return new
    start = newest - dt.timedelta(days=lookback_days)
    if monthly:
        start = start.replace(day=1)
    return between_dates(new, start=start, column=table.dataset.date_column)


def _audit(
    table: PublishedTable, base: Manifest, folder: str, schema: StructType
) -> tuple[dict[str, int], GateError | None]:
    """Rows per bucket of a staged folder, and the first failing check of the table with it.

    One job over the files just written gives both. Buckets that stay as they
    are are read only for checks the staged rows cannot settle, and then only
    the columns of the gate.
    """
    gate, name = table.dataset.gate, table.dataset.name
    columns = schema.fieldNames()
    staged = table.staged(folder, schema)
    per_bucket = staged.groupBy(BUCKET).agg(*gate_metrics(columns, gate))
    counts = F.collect_list(F.struct(BUCKET, "rows")).alias("counts")
    touched = set(table.staged_names(folder))
    rest = Manifest(
        base.version, {n: b for n, b in base.buckets.items() if n not in touched}, base.schema
    )
    whole = per_bucket.agg(counts, *combined_metrics(columns, gate))
    whole = whole.withColumn("rows", F.col("rows") + F.lit(rest.rows))
    row = whole.select("counts", F.array(*gate_rows(columns, gate)).alias("checks")).first()
    found = {bucket_folder(c[BUCKET]): c["rows"] for c in row["counts"]}
    error = first_failure(row["checks"], name)
    bounded = gate.min_date is not None or gate.max_date is not None
    if rest.buckets and (error is not None or bounded):
        others = align(table.read(manifest=rest), schema)
        both = staged.select(*columns).unionByName(others)
        error = first_failure(gate_report(both, gate).collect(), name)
    return found, error


def save_dataset(
    spark: SparkSession,
    store: str,
    dataset: Dataset | str,
    new: DataFrame,
    lookback_days: int | None = None,
    monthly_start: bool = False,
    extra: Mapping[str, str] | None = None,
) -> SaveOutcome:
    """Merge a batch into one dataset and publish it, all or nothing.

    ``lookback_days`` keeps only batch rows from that many days before the
    newest stored date on. An empty batch writes nothing.
    """
    dataset = DATASETS[dataset] if isinstance(dataset, str) else dataset
    table = PublishedTable(spark, store, dataset)
    base = table.manifest()
    fresh = _since_start(table, new, lookback_days, monthly_start)
    absent = missing_columns(fresh, dataset.keys)
    if absent:
        return SaveOutcome(dataset.name, "failed", f"required_columns: missing: {','.join(absent)}")
    if not base.buckets:
        rows = dedupe_grain(fresh, dataset.keys)
        schema = merged_schema(base.schema, rows.schema)
        return _publish(table, base, table.stage(align(rows, schema)), schema, extra)
    # The batch is read for its buckets and again for the merge.
    fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = touched_buckets(fresh, dataset)
        if not touched:
            return SaveOutcome(dataset.name, "skipped", "no rows")
        folder, schema = _stage_merged(table, base, fresh, touched)
        return _publish(table, base, folder, schema, extra)
    finally:
        fresh.unpersist()


def _publish(
    table: PublishedTable,
    base: Manifest,
    folder: str,
    schema: StructType,
    extra: Mapping[str, str] | None,
) -> SaveOutcome:
    """Check a staged folder and publish it."""
    name = table.dataset.name
    counts, error = _audit(table, base, folder, schema)
    if not counts:
        return SaveOutcome(name, "skipped", "no rows")
    if error is not None:
        return SaveOutcome(name, "failed", str(error))
    done = table.commit(base, folder, counts, schema, extra=dict(extra or {}))
    return SaveOutcome(name, "saved", None, done.version, done.rows)


def save_by_item(
    spark: SparkSession,
    store: str,
    dataset: Dataset | str,
    new: DataFrame,
    lookback_days: int | None = None,
    run_id: str | None = None,
    monthly_start: bool = False,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Merge a batch of many tickers or countries in one job, failures isolated.

    Every item is gated by itself, over what it has stored and what the batch
    brings. A failing item adds nothing and its stored rows stay as they are;
    the others are published. ``lookback_days`` gives every item its own start
    date, from the marks of the dataset.

    Returns the ledger of the run, one row per item: "saved" only where the
    store changed. ``expected`` (item, landed, rejected, problem) names more
    items, which landed without rows or were asked for. ``read_outcomes`` has
    the counts.
    """
    dataset = DATASETS[dataset] if isinstance(dataset, str) else dataset
    item = dataset.item_column
    table = PublishedTable(spark, store, dataset)
    base = table.manifest()
    run_id = run_id or f"{dataset.name}-{base.version + 1}"
    absent = missing_columns(new, dict.fromkeys((*dataset.keys, item)))
    if absent:
        reason = F.lit(f"required_columns: missing: {','.join(absent)}")
        named = new.select(F.col(item).alias("item")).distinct() if item in new.columns else spark.range(1).select(F.lit(dataset.name).alias("item"))
        record(named.select("item", F.lit("failed").alias("status"), reason.alias("reason")), store, run_id, dataset.name)
        return read_ledger(spark, store, run_id)
    taken = F.lit(True)
    if lookback_days is not None and base.buckets:
        known = as_stored(read_marks(table, base), dataset)
        starts = incremental_start_by(known, item, lookback_days, dataset.date_column, monthly_start)
        new = new.join(starts.withColumnRenamed("start_date", _START), item, "left")
        late = F.col(_START).isNull() | (F.col(dataset.date_column) >= F.col(_START))
        taken = F.coalesce(late, F.lit(False))
    # The batch is read for its buckets, for the merge and for the ledger.
    batch = new.withColumn(_TAKEN, taken).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fresh = batch.where(_TAKEN).drop(_TAKEN, _START)
        parts = [_batch_counts(batch, item)]
        if expected is not None:
            parts.append(_outcome_part(expected, landed="landed", rejected="rejected", problem="problem"))
        folder, schema, counts = None, None, {}
        touched = touched_buckets(fresh, dataset)
        if touched:
            folder, schema = _stage_merged(table, base, fresh, touched)
            failing = _failing(table, base, folder, schema, fresh.select(item), touched)
            # Failures are rare: only they pay for a second merge, of the batch without them.
            if not failing.isEmpty():
                parts.append(_outcome_part(failing.withColumnRenamed(item, "item"), failed="reason", spelled="item"))
                fresh = fresh.join(failing, fresh[item].eqNullSafe(failing[item]), "left_anti")
                folder = None if fresh.isEmpty() else _stage_merged(table, base, fresh, touched)[0]
        if folder is not None:
            changes = _changes(table, base, folder, schema, touched)
            parts.append(_outcome_part(changes.where("kept > 0 OR replaced > 0"), kept="kept", replaced="replaced"))
            counts = _changed_buckets(changes)
        outcomes = item_outcomes(relaxed_union(*parts))
        record(outcomes, store, run_id, dataset.name, folder if counts else None)
        if counts:
            done = table.commit(base, folder, counts, schema, extra={"run_id": run_id, "attempt": folder})
            if dataset.date_column and (lookback_days is not None or dataset.lookback_days is not None):
                move_marks(table, base, done, fresh)
        return read_ledger(spark, store, run_id)
    finally:
        batch.unpersist()


def _outcome_part(rows: DataFrame, **columns: str) -> DataFrame:
    """Partial counts of items, for ``item_outcomes``: its columns by the columns of ``rows``."""
    return rows.select(F.upper(F.col("item").cast("string")).alias("item"), *[F.col(c).alias(k) for k, c in columns.items()])


def _batch_counts(batch: DataFrame, item: str) -> DataFrame:
    counted = batch.groupBy(F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("batch"), F.count_if(F.col(_TAKEN)).alias("taken"))
    return _outcome_part(counted, batch="batch", taken="taken", spelled="item").withColumn("spelled", F.col("spelled").cast("string"))


def _changes(
    table: PublishedTable, base: Manifest, folder: str, schema: StructType, touched: set[str | None]
) -> DataFrame:
    """(bucket, item, rows, kept, replaced) of the staged files against the buckets they replace.

    Both sides are compared as multisets of row hashes: rows that are staged and
    were not there are kept, rows that were there and are not staged are
    replaced. Only hashes are shuffled, spread over all tasks.
    """
    dataset = table.dataset
    key = [dataset.bucket_expr().alias("bucket"), F.col(dataset.item_column).alias("item")]
    before = align(table.read(manifest=base, keep=touched.__contains__), schema)
    after = table.staged(folder, schema).drop(BUCKET)
    sides = [
        side.select(*key, row_hash(side).alias("hash"), F.lit(old).alias("old"), F.lit(1 - old).alias("now"))
        for side, old in ((after, 0), (before, 1))
    ]
    rows = sides[0].unionByName(sides[1]).groupBy("bucket", "item", "hash").agg(F.sum("old").alias("old"), F.sum("now").alias("now"))
    more = F.col("now") - F.col("old")
    changes = rows.groupBy("bucket", "item").agg(
        F.sum("now").alias("rows"), F.sum(F.greatest(more, F.lit(0))).alias("kept"), F.sum(F.greatest(-more, F.lit(0))).alias("replaced")
    )
    path = scratch_root(table.spark, "changes")
    changes.write.parquet(path)
    return table.spark.read.schema(changes.schema).parquet(path)


def _changed_buckets(changes: DataFrame) -> dict[str, int]:
    """Rows of each bucket that the staged files change; one row per bucket is collected."""
    moved = F.sum(F.col("kept") + F.col("replaced"))
    rows = changes.groupBy("bucket").agg(F.sum("rows").alias("rows"), moved.alias("moved")).where("moved > 0").collect()
    counts: dict[str, int] = {}
    for row in rows:
        name = bucket_folder(row["bucket"])
        counts[name] = counts.get(name, 0) + row["rows"]
    return counts


def _failing(
    table: PublishedTable,
    base: Manifest,
    folder: str,
    schema: StructType,
    items: DataFrame,
    touched: set[str | None],
) -> DataFrame:
    """Items of a batch that fail the gate with it, and the first check each fails.

    Buckets that the batch does not touch are read, for the gate's columns,
    only where their rows can change a verdict: a bound may be passed by all
    rows together, and a shortage in the staged rows be made up for.
    """
    item, gate = table.dataset.item_column, table.dataset.gate
    batch = items.distinct()
    staged = table.staged(folder, schema).join(batch, item, "left_semi")
    failing = failing_items(staged, item, gate)
    bounded = gate.max_rows is not None or gate.min_date is not None or gate.max_date is not None
    untouched = any(bucket_value(name) not in touched for name in base.buckets)
    if untouched and (bounded or not failing.isEmpty()):
        others = table.read(manifest=base, keep=lambda bucket: bucket not in touched)
        parts = staged.select(*schema.fieldNames()).unionByName(align(others, schema).join(batch, item, "left_semi"))
        failing = failing_items(parts, item, gate)
    path = scratch_root(table.spark, "failing")
    failing.write.parquet(path)
    return table.spark.read.schema(failing.schema).parquet(path)


def save_term_premiums(
    spark: SparkSession, store: str, spot: DataFrame, forward: DataFrame, lookback_days: int = 7
) -> SaveOutcome:
    """Spot and forward premiums into one dataset."""
    return save_dataset(
        spark, store, "gsw_term_premiums", relaxed_union(spot, forward), lookback_days
    )


def save_bundle(
    spark: SparkSession, store: str, batches: Mapping[str, DataFrame], run_id: str
) -> DataFrame:
    """Save several datasets; a failure does not stop the others. Returns their ledger.

    The loop runs over catalogue entries; each save is a Spark job of its own.
    """
    rows: list[tuple[str, str, str | None]] = []
    for name, batch in batches.items():
        dataset = DATASETS[name]
        try:
            outcome = save_dataset(
                spark, store, dataset, batch, dataset.lookback_days, dataset.monthly_start
            )
            rows.append((name, outcome.status, outcome.reason))
        except Exception as error:  # the reason is kept, the next dataset goes on
            rows.append((name, "failed", str(error).splitlines()[0]))
    for name, status, reason in rows:
        one = spark.createDataFrame([(name, status, reason)], "item STRING, status STRING, reason STRING")
        record(one.coalesce(1), store, run_id, name)
    return spark.createDataFrame([(run_id, name, name, status, reason) for name, status, reason in rows], LEDGER_SCHEMA)


def read_dataset(spark: SparkSession, store: str, name: str, key: str | None = None) -> DataFrame:
    """A stored dataset, or the rows of one ticker, country, market or underlying."""
    table = PublishedTable(spark, store, DATASETS[name])
    return table.read() if key is None else table.read_key(key)


def read_datasets(spark: SparkSession, store: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_dataset(spark, store, name) for name in names}
