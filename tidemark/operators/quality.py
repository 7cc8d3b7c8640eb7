"""Data-quality gates: one aggregate job per dataset, reported as rows."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import Gate


class GateError(Exception):
    """A dataset failed a gate."""

    def __init__(self, message: str, failures: dict[str, Any] | None = None):
        super().__init__(message)
        self.failures = failures or {}


# Checks in the order in which the first failure is reported.
CHECKS = (
    "not_empty",
    "row_count",
    "required_columns",
    "not_all_null",
    "date_column",
    "min_date",
    "max_date",
)


def missing_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c not in have]


def gate_metrics(columns: Iterable[str], gate: Gate) -> list[Column]:
    """The aggregates a gate needs, for columns that exist."""
    have = set(columns)
    out = [F.count(F.lit(1)).alias("rows")]
    out += [
        F.count(F.col(f"`{c}`")).alias(f"filled:{c}") for c in gate.not_all_null if c in have
    ]
    if gate.date_column in have:
        date = F.col(f"`{gate.date_column}`").cast("date")
        out += [F.min(date).alias("min_date"), F.max(date).alias("max_date")]
    return out


def combined_metrics(columns: Iterable[str], gate: Gate) -> list[Column]:
    """Aggregates that join ``gate_metrics`` of parts into those of the whole."""
    have = set(columns)
    out = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for c in gate.not_all_null:
        if c in have:
            out.append(F.coalesce(F.sum(f"`filled:{c}`"), F.lit(0)).alias(f"filled:{c}"))
    if gate.date_column in have:
        out += [F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date")]
    return out


def _row(check: str, ok: Column, expected: Column, actual: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
        expected.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
    )


def gate_rows(columns: Iterable[str], gate: Gate) -> list[Column]:
    """One struct per check, computed from the columns of ``gate_metrics``."""
    columns = list(columns)
    n = F.col("rows")
    rows = [_row("not_empty", n > 0, F.lit("rows > 0"), n)]
    bounds = f">= {gate.min_rows}" + (f", <= {gate.max_rows}" if gate.max_rows is not None else "")
    in_bounds = n >= gate.min_rows
    if gate.max_rows is not None:
        in_bounds = in_bounds & (n <= gate.max_rows)
    rows.append(_row("row_count", in_bounds, F.lit(bounds), n))
    if gate.required:
        absent = [c for c in gate.required if c not in columns]
        rows.append(
            _row(
                "required_columns",
                F.lit(not absent),
                F.lit(",".join(gate.required)),
                F.lit("missing: " + ",".join(absent) if absent else "all present"),
            )
        )
    if gate.not_all_null:
        hollow = F.array_compact(
            F.array(
                *[
                    F.when(F.col(f"`filled:{c}`") == 0, F.lit(c)) if c in columns else F.lit(c)
                    for c in gate.not_all_null
                ]
            )
        )
        rows.append(
            _row(
                "not_all_null",
                F.size(hollow) == 0,
                F.lit(",".join(gate.not_all_null)),
                F.concat(F.lit("all null: "), F.concat_ws(",", hollow)),
            )
        )
    if gate.date_column:
        present = gate.date_column in columns
        if not present:
            rows.append(
                _row("date_column", F.lit(False), F.lit(gate.date_column), F.lit("missing"))
            )
        # A bound with no date to compare is not a failure.
        if present and gate.min_date is not None:
            low = F.col("min_date")
            ok = low.isNull() | (low >= F.lit(gate.min_date).cast("date"))
            rows.append(_row("min_date", ok, F.lit(f">= {gate.min_date}"), low))
        if present and gate.max_date is not None:
            high = F.col("max_date")
            ok = high.isNull() | (high <= F.lit(gate.max_date).cast("date"))
            rows.append(_row("max_date", ok, F.lit(f"<= {gate.max_date}"), high))
    return rows


def gate_report(df: DataFrame, gate: Gate) -> DataFrame:
    """One row per check: check, ok, expected, actual. One aggregate over a pruned scan."""
    metrics = df.agg(*gate_metrics(df.columns, gate))
    return metrics.select(F.inline(F.array(*gate_rows(df.columns, gate))))


def gate_report_by(df: DataFrame, item: str, gate: Gate) -> DataFrame:
    """The same per ticker or country, in one aggregate; adds the item column."""
    metrics = df.groupBy(item).agg(*gate_metrics(df.columns, gate))
    return metrics.select(F.col(item), F.inline(F.array(*gate_rows(df.columns, gate))))


def failing_items(df: DataFrame, item: str, gate: Gate) -> DataFrame:
    """Items that fail, each with the first failing check in order."""
    metrics = df.groupBy(item).agg(*gate_metrics(df.columns, gate))
    checks = F.array(*gate_rows(df.columns, gate))
    failed = F.filter(checks, lambda c: ~c["ok"])
    return (
        metrics.withColumn("__failed", failed)
        .where(F.size("__failed") > 0)
        .select(
            F.col(item),
            F.concat_ws(": ", F.col("__failed")[0]["check"], F.col("__failed")[0]["actual"]).alias(
                "reason"
            ),
        )
    )


def first_failure(report_rows: Iterable, context: str) -> GateError | None:
    """The error for the first failing check of a report, if any."""
    by_check = {r["check"]: r for r in report_rows}
    for check in CHECKS:
        row = by_check.get(check)
        if row is not None and not row["ok"]:
            detail = {check: {"expected": row["expected"], "actual": row["actual"]}}
            return GateError(
                f"{context} failed {check}: expected {row['expected']}, got {row['actual']}", detail
            )
    return None


def enforce(df: DataFrame, gate: Gate, context: str = "dataset") -> None:
    """Raise on the first failing check. The report has one row per check, never per data row."""
    error = first_failure(gate_report(df, gate).collect(), context)
    if error is not None:
        raise error


def constraint_report(
    df: DataFrame, not_null: Iterable[str], primary_key: Iterable[str]
) -> DataFrame:
    """Violations of the declared NOT NULL columns and of primary-key uniqueness."""
    not_null, primary_key = list(not_null), list(primary_key)
    nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in not_null])
    null_rows = nulls.unpivot(
        [], [F.col(f"`{c}`") for c in not_null], "column", "violations"
    ).select(F.concat(F.lit("not_null:"), F.col("column")).alias("check"), "violations")
    doubled = (
        df.groupBy(*[F.col(f"`{c}`") for c in primary_key])
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(
            F.lit("primary_key:" + ",".join(primary_key)).alias("check"), F.col("violations")
        )
    )
    return null_rows.unionByName(doubled).withColumn("ok", F.col("violations") == 0)
