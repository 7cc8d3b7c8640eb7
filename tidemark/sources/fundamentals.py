"""Company statements, profiles and adjusted price series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.catalog import DATASETS
from tidemark.functions import (
    bind,
    lenient_date,
    null_token_number,
    null_token_text,
    series_label,
    snake_case,
    to_long,
)
from tidemark.operators.project import with_audit
from tidemark.sources.landed import error_payload, is_broken_json, quarantine

STATEMENTS = ("income_statement", "balance_sheet", "cash_flow", "earnings")
INTERVALS = ("daily_adjusted", "weekly_adjusted", "monthly_adjusted")


def _promote(fields: Column, f: T.StructField) -> Column:
    """A declared column out of the text map, with "no value" tokens as null."""
    text = fields[f.name]
    if isinstance(f.dataType, T.DoubleType):
        return null_token_number(text)
    if isinstance(f.dataType, T.LongType):
        # Long texts may be written as doubles ("2.5E12").
        return F.coalesce(to_long(null_token_text(text)), to_long(null_token_number(text)))
    return null_token_text(text)


def _declared(name: str, fixed: tuple[str, ...]) -> list[T.StructField]:
    skip = set(fixed) | {"source", "last_fetched_at", "extra"}
    return [f for f in DATASETS[name].schema if f.name not in skip]


def _finish(
    rows: DataFrame, name: str, fixed: tuple[str, ...], batch_ts: dt.datetime | str
) -> DataFrame:
    """Fixed columns, promoted columns, the rest in ``extra``, audit columns."""
    promoted = _declared(name, fixed)
    known = [f.name for f in promoted]
    numbers = [f.name for f in promoted if not isinstance(f.dataType, T.StringType)]
    # Text where a number is declared is no number, but it is kept.
    stray = lambda k, v: k.isin(numbers) & null_token_number(v).isNull()
    rest = F.map_filter("fields", lambda k, v: (~k.isin(known) | stray(k, v)) & null_token_text(v).isNotNull())
    shaped = rows.select(
        *fixed, *[_promote(F.col("fields"), f).alias(f.name) for f in promoted], rest.alias("extra")
    )
    audited = with_audit(shaped, K.SOURCE_FUNDAMENTALS, batch_ts)
    return audited.select(*[f.name for f in DATASETS[name].schema])


def _snake_keys(fields: Column, drop: tuple[str, ...] = ()) -> Column:
    kept = F.map_filter(fields, lambda k, v: ~k.isin(list(drop))) if drop else fields
    return F.transform_keys(kept, lambda k, v: snake_case(k))


def statement_problem() -> Column:
    """Why a statement payload cannot be used, else null."""
    raw = F.col("raw")
    return F.when(is_broken_json(raw), F.lit("not JSON")).otherwise(error_payload(raw))


def fundamentals(landed: DataFrame, statement: str, batch_ts: dt.datetime | str) -> DataFrame:
    """Annual and quarterly reports to one row each.

    Columns the catalogue does not declare stay in the ``extra`` map, so new
    vendor fields need no pass over the data to be discovered.
    """
    if statement not in STATEMENTS:
        raise ValueError(f"unknown statement {statement!r}, must be one of {STATEMENTS}")
    suffix = "Earnings" if statement == "earnings" else "Reports"
    sections = {"annual": f"annual{suffix}", "quarterly": f"quarterly{suffix}"}
    reports = "array<map<string,string>>"
    payload = F.from_json("raw", ", ".join(f"{s} {reports}" for s in sections.values()))

    def tagged(kind: str, section: str) -> Column:
        return F.transform(
            F.coalesce(F.col("payload")[section], F.array().cast(reports)),
            lambda r: F.struct(F.lit(kind).alias("report_type"), r.alias("report")),
        )

    rows = landed.select("symbol", payload.alias("payload")).select(
        "symbol", F.inline(F.concat(*[tagged(k, s) for k, s in sections.items()]))
    )
    currency = F.when(
        F.map_contains_key("report", F.lit("reportedCurrency")), F.col("report")["reportedCurrency"]
    ).otherwise(F.lit("USD"))
    shaped = rows.select(
        F.upper("symbol").alias("ticker"),
        "report_type",
        lenient_date(F.col("report")["fiscalDateEnding"]).alias("fiscal_date_ending"),
        currency.alias("reported_currency"),
        _snake_keys(F.col("report"), ("fiscalDateEnding", "reportedCurrency")).alias("fields"),
    )
    fixed = ("ticker", "report_type", "fiscal_date_ending", "reported_currency")
    return _finish(shaped, statement, fixed, batch_ts)


def overview_problem() -> Column:
    """Why a profile cannot be used, else null."""
    absent = F.get_json_object("raw", "$.Symbol").isNull()
    return F.coalesce(statement_problem(), F.when(absent, F.lit("no symbol")))


def overview(landed: DataFrame, batch_ts: dt.datetime | str) -> DataFrame:
    """Company profiles, one row each; payloads without ``Symbol`` give none."""
    rows = landed.select(
        F.upper("symbol").alias("ticker"), F.from_json("raw", "map<string,string>").alias("profile")
    ).where(F.map_contains_key("profile", F.lit("Symbol")))
    shaped = rows.select("ticker", _snake_keys(F.col("profile"), ("Symbol",)).alias("fields"))
    return _finish(shaped, "overview", ("ticker",), batch_ts)


def _series_block(raw: Column) -> Column:
    """Text of the block whose key holds "Time Series", else null."""
    blocks = F.map_filter(
        F.from_json(raw, "map<string,string>"), lambda k, v: k.contains("Time Series")
    )
    return F.try_element_at(F.map_values(blocks), F.lit(1))


def adjusted_problem() -> Column:
    """Why a price-series payload cannot be used, else null."""
    raw = F.col("raw")
    block = _series_block(raw)
    days = F.map_keys(F.from_json(block, "map<string,map<string,string>>"))
    return (
        F.when(is_broken_json(raw), F.lit("not JSON"))
        .when(error_payload(raw).isNotNull(), error_payload(raw))
        .when(block.isNull(), F.lit("no series"))
        .when(F.exists(days, lambda d: lenient_date(d).isNull()), F.lit("bad date"))
    )


def adjusted_series(landed: DataFrame, interval: str, batch_ts: dt.datetime | str) -> DataFrame:
    """Date-keyed price maps to one row per date. Payloads with a bad date are left out."""
    if interval not in INTERVALS:
        raise ValueError(f"unknown interval {interval!r}, must be one of {INTERVALS}")
    days = F.from_json(_series_block(F.col("raw")), "map<string,map<string,string>>")
    sound = bind(
        days,
        lambda d: F.when(~F.exists(F.map_keys(d), lambda day: lenient_date(day).isNull()), d),
    )
    rows = landed.select(
        F.upper("symbol").alias("ticker"), F.explode(sound).alias("day", "values")
    )
    shaped = rows.select(
        "ticker",
        F.col("day").cast("date").alias("date"),
        F.lit(interval).alias("interval"),
        F.transform_keys("values", lambda k, v: series_label(k)).alias("fields"),
    )
    return _finish(shaped, interval, ("ticker", "date", "interval"), batch_ts)


def fundamentals_quarantine(landed: DataFrame) -> DataFrame:
    return quarantine(landed, statement_problem())


def adjusted_quarantine(landed: DataFrame) -> DataFrame:
    return quarantine(landed, adjusted_problem())
