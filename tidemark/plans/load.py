"""Loads of published datasets into the typed tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog import DATASETS, TABLES, TableSpec
from tidemark.operators.merge import dedupe_grain, upsert
from tidemark.operators.project import conform, intersect_columns
from tidemark.operators.union import relaxed_union
from tidemark.plans.save import touched_buckets
from tidemark.sinks.published import PublishedTable

LOAD_SCHEMA = "table STRING, status STRING, reason STRING, rows BIGINT, columns INT"


def with_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared defaults: the source label, and now as the fetch time."""
    defaults = {"source": F.lit(spec.source_default), "last_fetched_at": F.current_timestamp()}
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), default) if c in df.columns else default
            for c, default in defaults.items()
        }
    )


def loadable(df: DataFrame, spec: TableSpec) -> tuple[DataFrame | None, str | None]:
    """The columns both sides have, in table order, or why the load is skipped."""
    if spec.require_date and "date" not in df.columns:
        return None, "no date column"
    matched = intersect_columns(df, spec.schema.fieldNames())
    if not matched.columns:
        return None, "no matching columns"
    types = T.StructType([f for f in spec.schema if f.name in matched.columns])
    return conform(matched, types), None


def load_table(spark: SparkSession, store: str, spec: TableSpec | str, df: DataFrame) -> tuple:
    """Load one table: replace its rows, or upsert them by primary key.

    An empty source leaves the table as it is. Buckets whose rows come again
    as they are keep their files, compacted or not. Rows that break the declared
    keys are set aside and counted in ``reason``: of rows with one primary key
    the one fetched last stays, rows with a null where none may be go. Returns
    a row of ``LOAD_SCHEMA``.
    """
    spec = TABLES[spec] if isinstance(spec, str) else spec
    rows, reason = loadable(df, spec)
    if rows is None:
        return (spec.name, "skipped", reason, 0, 0)
    matched = len(rows.columns)
    table = PublishedTable(spark, store, spec.dataset())
    base = table.manifest()
    if spec.mode == "upsert" and base.buckets:
        return _upsert_table(table, base, spec, rows, matched)
    final = conform(with_defaults(rows, spec), spec.schema)
    total = final.agg(F.count(F.lit(1)), F.count_if(~_filled(spec))).first()
    folder = table.stage(dedupe_grain(final.where(_filled(spec)), spec.primary_key))
    found = table.staged_prints(folder, spec.schema)
    counts = {name: rows for name, (rows, _) in found.items()}
    aside = _aside(total[1], total[0] - total[1] - sum(counts.values()))
    if not counts:
        return (spec.name, "skipped", aside or "no rows", 0, matched)
    prints = {name: mark for name, (_, mark) in found.items()}
    table.commit(base, folder, counts, spec.schema, replace_all=True, prints=prints)
    return (spec.name, "loaded", aside, sum(counts.values()), matched)


def _filled(spec: TableSpec) -> Column:
    """Whether a row has all that the table declares as never null."""
    columns = dict.fromkeys([*spec.primary_key, *spec.not_null])
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns])


def _aside(nulls: int, repeats: int) -> str | None:
    parts = [f"{n} rows with {what}" for n, what in ((nulls, "null keys"), (repeats, "repeated keys")) if n]
    return "set aside: " + ", ".join(parts) if parts else None


def _upsert_table(table: PublishedTable, base, spec: TableSpec, rows: DataFrame, matched: int):
    # The bucket is a function of the key (snapshot date of the snapshot time),
    # so a key never leaves its bucket.
    keyed = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in spec.primary_key])
    total = rows.agg(F.count(F.lit(1)), F.count_if(~keyed)).first()
    rows = rows.where(keyed)
    touched = touched_buckets(rows, table.dataset)
    if not touched:
        return (spec.name, "skipped", _aside(total[1], 0) or "no rows", 0, matched)
    merged = upsert(table.read(manifest=base, keep=touched.__contains__), rows, spec.primary_key)
    folder = table.stage(conform(with_defaults(merged, spec), spec.schema))
    counts = table.staged_counts(folder, spec.schema)
    table.commit(base, folder, counts, spec.schema)
    return (spec.name, "upserted", _aside(total[1], 0), total[0] - total[1], matched)


def load_all(
    spark: SparkSession, source_store: str, target_store: str, tables: Iterable[str] | None = None
) -> DataFrame:
    """Load every table whose datasets are published; one load per table over all tickers.

    Returns one row per table with its outcome.
    """
    out = []
    for name in tables or TABLES:
        spec = TABLES[name]
        sources = [PublishedTable(spark, source_store, DATASETS[d]) for d in spec.datasets]
        present = [t.read() for t in sources if t.exists()]
        if not present:
            out.append((name, "skipped", "not published", 0, 0))
            continue
        out.append(load_table(spark, target_store, spec, relaxed_union(*present)))
    return spark.createDataFrame(out, LOAD_SCHEMA)


def table_counts(spark: SparkSession, store: str, tables: Iterable[str] | None = None) -> DataFrame:
    """Rows per table, from the manifests; null for a table that does not exist."""
    rows = []
    for name in tables or TABLES:
        table = PublishedTable(spark, store, TABLES[name].dataset())
        rows.append((name, table.manifest().rows if table.exists() else None))
    return spark.createDataFrame(rows, "table STRING, rows BIGINT")


def frame_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per DataFrame, counted in one job without reading a column."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in frames.items()
    ]
    out = counted[0]
    for df in counted[1:]:
        out = out.unionByName(df)
    return out


def write_jdbc(df: DataFrame, spec: TableSpec | str, url: str, properties: dict[str, str]) -> None:
    """Load an outside database table: truncate, then append, in parallel per partition."""
    spec = TABLES[spec] if isinstance(spec, str) else spec
    rows, reason = loadable(df, spec)
    if rows is None:
        raise ValueError(f"{spec.name}: {reason}")
    rows.write.option("truncate", "true").jdbc(url, spec.name, "overwrite", properties)
