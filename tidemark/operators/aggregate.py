"""Time-bucket rollups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import first_by, last_by, time_bucket


@dataclass(frozen=True)
class Rollup:
    """A rollup: bucket width, group columns, measures and how far back it is refreshed."""

    name: str
    base: str
    width: str
    group_by: tuple[str, ...]
    start_months: int
    end_days: int = 1
    date_column: str = "date"

    def measures(self, *order: str) -> list[Column]:
        """Aggregates of the rollup; ``order`` overrides the date for first / last values."""
        return _MEASURES[self.name](order or (self.date_column,))


def _yield_measures(_order) -> list[Column]:
    return [
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("obs_count"),
    ]


def _bar_measures(order) -> list[Column]:
    return [
        first_by("open", *order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        last_by("close", *order).alias("close"),
        F.sum("volume").alias("total_volume"),
        F.avg("vwap").alias("avg_vwap"),
        F.count(F.lit(1)).alias("trading_days"),
    ]


def _index_measures(order) -> list[Column]:
    return [
        F.avg("value").alias("avg_value"),
        last_by("value", *order).alias("latest_value"),
        F.count(F.lit(1)).alias("obs_count"),
    ]


def _gdp_measures(order) -> list[Column]:
    return [
        F.avg("value").alias("avg_gdp"),
        last_by("value", *order).alias("latest_gdp"),
        F.count(F.lit(1)).alias("obs_count"),
    ]


_MEASURES = {
    "yield_monthly": _yield_measures,
    "ohlcv_monthly": _bar_measures,
    "hicp_monthly": _index_measures,
    "gdp_quarterly": _gdp_measures,
}

ROLLUPS: dict[str, Rollup] = {
    r.name: r
    for r in (
        Rollup("yield_monthly", "fred_yield_curves", "month", ("component", "tenor"), 3),
        Rollup("ohlcv_monthly", "market_data_daily", "month", ("ticker",), 3),
        Rollup("hicp_monthly", "ecb_hicp", "month", ("series_label",), 6),
        Rollup("gdp_quarterly", "eurostat_gdp", "quarter", ("country",), 24),
    )
}


def roll_up(
    df: DataFrame, rollup: Rollup, width: str | None = None, order: tuple[str, ...] = ()
) -> DataFrame:
    """Aggregate to (bucket, group columns). Partial sums are formed before the shuffle."""
    bucket = time_bucket(width or rollup.width, rollup.date_column).alias("bucket")
    return df.groupBy(bucket, *rollup.group_by).agg(*rollup.measures(*order))


def yield_monthly(df: DataFrame) -> DataFrame:
    return roll_up(df, ROLLUPS["yield_monthly"])


def ohlcv(df: DataFrame, width: str = "month", order: tuple[str, ...] = ()) -> DataFrame:
    return roll_up(df, ROLLUPS["ohlcv_monthly"], width, order)


def hicp_monthly(df: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    return roll_up(df, ROLLUPS["hicp_monthly"], order=order)


def gdp_quarterly(df: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    return roll_up(df, ROLLUPS["gdp_quarterly"], order=order)
