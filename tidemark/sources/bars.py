"""Daily bars, open/close snapshots, company details and ticker listings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.catalog import DATASETS
from tidemark.functions import bind, lenient_date, ms_to_date
from tidemark.operators.limits import paged_limit
from tidemark.operators.project import between_dates, conform, with_audit
from tidemark.sources.landed import error_payload, is_broken_json

BAR_PAYLOAD = (
    "timestamp BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, "
    "vwap DOUBLE, transactions BIGINT"
)
_BAR_COLUMNS = ("date", "open", "high", "low", "close", "volume", "vwap", "transactions")
OPEN_CLOSE_PAYLOAD = (
    "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE, vwap DOUBLE, "
    "afterHours DOUBLE, preMarket DOUBLE"
)
DETAILS_PAYLOAD = (
    "name STRING, market STRING, locale STRING, primary_exchange STRING, type STRING, "
    "active BOOLEAN, currency_name STRING, cik STRING, market_cap DOUBLE, list_date STRING, "
    "total_employees BIGINT, address STRING, branding STRING"
)
LISTING_PAYLOAD = (
    "ticker STRING, name STRING, market STRING, locale STRING, primary_exchange STRING, "
    "type STRING, active BOOLEAN, currency_name STRING"
)


# A line of bars as it lands: every field once, and what a vendor sends in place of data.
_BAR_LINE = (
    BAR_PAYLOAD.replace("timestamp BIGINT", "timestamp STRING")
    + ", ticker STRING, `Error Message` STRING, Note STRING, Information STRING, _corrupt_record STRING"
)


def _judged_bar(line: Column) -> Column:
    """A parsed line as a bar with its ticker, date and the reason why it cannot be used, else null."""
    error = F.coalesce(line["Error Message"], line["Note"], line["Information"])
    time = line["timestamp"].try_cast("bigint")
    broken = line["_corrupt_record"].isNotNull() & F.coalesce(line["ticker"], line["timestamp"], error).isNull()
    reason = (
        F.when(line.isNull() | broken, F.lit("not JSON"))
        .when(error.isNotNull(), error)
        .when(line["timestamp"].isNull(), F.lit("no timestamp"))
        .when(time.isNull(), F.lit("bad timestamp"))
    )
    numbers = [f.split(" ")[0] for f in BAR_PAYLOAD.split(", ")][1:]
    return F.struct(
        line["ticker"].alias("ticker"), ms_to_date(time).alias("date"), *[line[n].alias(n) for n in numbers],
        reason.alias("reason"),
    )


def parse_bars(raw: Column) -> Column:
    """A line of bars parsed and judged, with one parse: ticker, date, the bar's fields, reason."""
    parsed = F.from_json(raw, _BAR_LINE, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return bind(parsed, _judged_bar)


def shape_bars(parsed: DataFrame, batch_ts: dt.datetime | str) -> DataFrame:
    """Usable lines (``ticker``, ``bar``) to the bars table."""
    rows = parsed.select(F.upper("ticker").alias("ticker"), *[F.col(f"bar.{c}").alias(c) for c in _BAR_COLUMNS])
    return conform(with_audit(rows, K.SOURCE_BARS, batch_ts), DATASETS["daily_bars"].schema)


def daily_bars(
    landed: DataFrame,
    batch_ts: dt.datetime | str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Vendor bars, one JSON object per row, to the bars table. Missing fields are null.

    The filter stands inside the array that is unnested, so that it does not repeat the parse.
    """
    parsed = F.transform(F.array(F.from_json("raw", _BAR_LINE, {"columnNameOfCorruptRecord": "_corrupt_record"})), _judged_bar)
    usable = F.filter(parsed, lambda bar: bar["date"].isNotNull())
    rows = landed.select(F.upper("symbol").alias("symbol"), F.inline(usable)).select(
        F.col("symbol").alias("ticker"), *_BAR_COLUMNS
    )
    rows = conform(with_audit(rows, K.SOURCE_BARS, batch_ts), DATASETS["daily_bars"].schema)
    return between_dates(rows, start, end)


def open_close(
    landed: DataFrame, batch_ts: dt.datetime | str, date: str | Column = "date"
) -> DataFrame:
    """Open/close snapshots with after-hours and pre-market prices.

    ``date`` is the requested day, one for the batch or a text column.
    """
    day = F.col(date) if isinstance(date, str) and date in landed.columns else date
    day = F.lit(day) if isinstance(day, str) else day
    rows = landed.select(
        F.upper("symbol").alias("ticker"),
        lenient_date(day).alias("date"),
        F.from_json("raw", OPEN_CLOSE_PAYLOAD).alias("bar"),
    ).select("ticker", "date", "bar.*")
    rows = rows.withColumnsRenamed({"afterHours": "after_hours", "preMarket": "pre_market"})
    return conform(
        with_audit(rows, K.SOURCE_BARS, batch_ts), DATASETS["daily_open_close"].schema
    )


def _with_extra(raw: Column, payload: str, name: str) -> tuple[Column, Column]:
    """Declared fields of an object, nested ones as their JSON text, and a map of all others."""
    declared = [f.split(" ")[0] for f in payload.split(", ")]
    every = F.from_json(raw, "map<string,string>")
    others = F.map_filter(every, lambda k, v: ~k.isin(declared) & v.isNotNull())
    return F.from_json(raw, payload).alias(name), others.alias("extra")


def ticker_details(landed: DataFrame, batch_ts: dt.datetime | str) -> DataFrame:
    """Company details, one row per payload; fields that are not declared stay in ``extra``."""
    details, extra = _with_extra(F.col("raw"), DETAILS_PAYLOAD, "details")
    rows = landed.select(F.upper("symbol").alias("ticker"), details, extra).select("ticker", "details.*", "extra")
    return conform(with_audit(rows, K.SOURCE_BARS, batch_ts), DATASETS["ticker_details"].schema)


def payload_problem() -> Column:
    """Why a JSON payload cannot be used, else null."""
    raw = F.col("raw")
    return F.when(is_broken_json(raw), F.lit("not JSON")).otherwise(error_payload(raw))


def listing_problem() -> Column:
    """Why a line of a listing cannot be used, else null."""
    return F.coalesce(payload_problem(), F.when(F.get_json_object("raw", "$.ticker").isNull(), F.lit("no ticker")))


def ticker_list(
    landed: DataFrame, batch_ts: dt.datetime | str, market: str | None = None, limit: int | None = None
) -> DataFrame:
    """Listing of all markets, or of one; fields that are not declared stay in ``extra``.

    With a ``limit``, the first rows by ticker, rounded up to whole pages.
    """
    entry, extra = _with_extra(F.col("raw"), LISTING_PAYLOAD, "entry")
    rows = landed.select(entry, extra).select("entry.*", "extra").where(F.col("ticker").isNotNull())
    if market is not None:
        rows = rows.where(F.col("market") == market)
    if limit is not None:
        rows = rows.orderBy("ticker").limit(paged_limit(limit))
    return conform(with_audit(rows, K.SOURCE_BARS, batch_ts), DATASETS["ticker_list"].schema)
