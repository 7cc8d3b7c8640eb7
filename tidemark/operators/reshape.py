"""Long and wide forms of curves, statistical tables and option chains."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.catalog import DATASETS
from tidemark.functions import (
    lenient_number,
    looks_like_period,
    parse_period,
    to_bool,
    to_decimal6,
    to_long,
    utc_date,
)
from tidemark.operators.project import conform, drop_null_obs, empty_like, with_audit
from tidemark.operators.union import relaxed_union


class UnmappedSeries(ValueError):
    """A tenor has no series id."""


def map_series_id(
    df: DataFrame, mapping: Mapping[str, str], key: str = "tenor", out: str = "fred_series_id"
) -> DataFrame:
    """Add the series id of every tenor; an unmapped tenor fails the job."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    column = F.col(f"`{key}`")
    # A missing map key reads as null, so the check has to be explicit.
    failed = F.raise_error(F.concat(F.lit("no series id for "), F.coalesce(column, F.lit("null"))))
    looked_up = F.element_at(F.create_map(*pairs), column) if pairs else F.lit(None)
    return df.withColumn(out, F.coalesce(looked_up, failed.cast("string")))


def curve_to_long(
    wide: DataFrame,
    mapping: Mapping[str, str],
    component: str,
    batch_ts: dt.datetime | str,
    source: str = K.SOURCE_FRED,
) -> DataFrame:
    """Wide curve to one row per (date, tenor); missing values stay as null rows."""
    schema = DATASETS["treasury_constant_maturity"].schema
    tenors = [c for c in wide.columns if c != "date"]
    if not tenors:
        return empty_like(wide.sparkSession, schema)
    unmapped = [t for t in tenors if t not in mapping]
    if unmapped:
        raise UnmappedSeries(f"no series id for {unmapped}")
    long = wide.unpivot(["date"], [F.col(f"`{t}`") for t in tenors], "tenor", "value")
    long = map_series_id(long, mapping)
    return conform(with_audit(long, source, batch_ts, component=component), schema)


def curve_wide(
    long: DataFrame,
    tenors: Iterable[str],
    tenor: str | Column = "tenor",
    value: str = "value",
    index: str = "date",
    newest_by: str | None = None,
) -> DataFrame:
    """One row per date and one column per tenor, in the order given.

    A conditional aggregate per tenor needs one shuffle, on the date; a pivot
    would shuffle twice. Tenors without rows become all-null columns. With
    ``newest_by`` the row fetched last wins where a tenor repeats on a date.
    """
    label = F.col(tenor) if isinstance(tenor, str) else tenor
    cells = []
    for t in tenors:
        here = label == F.lit(t)
        cell = F.when(here, F.col(value))
        if newest_by is None:
            cells.append(F.max(cell).alias(t))
        else:
            cells.append(F.max_by(cell, F.when(here, F.col(newest_by))).alias(t))
    return long.groupBy(index).agg(*cells)


def merge_series(
    frames: Iterable[DataFrame], names: Iterable[str], index: str = "date"
) -> DataFrame:
    """Full outer join of single-series frames ``(date, <name>)`` on the date.

    Stated as one union and one wide aggregate: one shuffle, not one per series.
    """
    names = list(names)
    long = [
        f.select(F.col(index), F.lit(n).alias("series"), F.col(f"`{n}`").cast("double").alias("value"))
        for f, n in zip(frames, names, strict=True)
    ]
    return curve_wide(reduce(DataFrame.union, long), names, tenor="series", index=index)


def fill_failed_series(wide: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add an all-null double column for every series that could not be read."""
    have = set(wide.columns)
    return wide.withColumns({n: F.lit(None).cast("double") for n in names if n not in have})


def prefixed_tenor(component: str | Column = "component", tenor: str = "tenor") -> Column:
    """Tenor with the prefix of its component (``ZC_5Y``), so spot and forward never collide."""
    column = F.col(component) if isinstance(component, str) else component
    prefix = F.create_map(*[F.lit(x) for item in K.CURVE_PREFIXES.items() for x in item])
    return F.concat(F.element_at(prefix, column), F.col(tenor))


def full_curve(
    long: DataFrame,
    components: Iterable[str] = ("constant_maturity", "zero_coupon", "instantaneous_forward"),
    long_format: bool = False,
    newest_by: str | None = None,
) -> DataFrame:
    """All requested components in one wide table, or as a dense (date, tenor) grid."""
    components = list(components)
    columns = [K.CURVE_PREFIXES[c] + t for c in components for t in K.CURVES[c]]
    rows = long.where(F.col("component").isin(components))
    wide = curve_wide(rows, columns, tenor=prefixed_tenor(), newest_by=newest_by)
    if not long_format:
        return wide
    return wide.unpivot(["date"], [F.col(f"`{c}`") for c in columns], "tenor", "value")


def single_curve(
    long: DataFrame,
    component: str,
    tenors: Iterable[str] | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    """Wide form of one component, for all its tenors or those named."""
    wanted = set(tenors) if tenors is not None else None
    columns = [t for t in K.CURVES[component] if wanted is None or t in wanted]
    rows = long.where((F.col("component") == component) & F.col("tenor").isin(columns))
    return curve_wide(rows, columns, newest_by=newest_by)


def periods_to_long(
    wide: DataFrame,
    indicator: str,
    batch_ts: dt.datetime | str,
    extra: Mapping[str, str | Column] | None = None,
    source: str = K.SOURCE_EUROSTAT,
) -> DataFrame:
    """Statistical table with one column per period to one row per observation.

    Period columns are told by name; all other columns are dimensions and stay.
    """
    kinds = {f.name: f.dataType for f in wide.schema}
    periods = [c for c in wide.columns if looks_like_period(c)]
    dims = [F.col(f"`{c}`") for c in wide.columns if c not in periods]
    if not periods:
        absent = {"date": F.lit(None).cast("date"), "value": F.lit(None).cast("double")}
        long = wide.withColumns(absent).where(F.lit(False))
    else:
        # The date of a column is a constant, so period texts are parsed once per
        # query, not once per row.
        cells = [
            F.struct(
                parse_period(F.lit(p)).alias("date"), _cell_value(p, kinds[p]).alias("value")
            )
            for p in periods
        ]
        long = drop_null_obs(wide.select(*dims, F.inline(F.array(*cells))))
    for name, value in (extra or {}).items():
        long = long.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    return with_audit(long, source, batch_ts, indicator=indicator)


def _cell_value(column: str, kind: T.DataType) -> Column:
    """Value of a period column: text leniently, numbers as they are but for NaN."""
    value = F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        return lenient_number(value)
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


_CHAIN_NAMES = {
    "contractSymbol": "contract_symbol",
    "lastTradeDate": "last_trade_date",
    "lastPrice": "last_price",
    "percentChange": "percent_change",
    "openInterest": "open_interest",
    "impliedVolatility": "implied_volatility",
    "inTheMoney": "in_the_money",
    "contractSize": "contract_size",
}
_MONEY = ("strike", "last_price", "bid", "ask", "change", "underlying_price")


def chains_to_long(
    calls: DataFrame, puts: DataFrame, source: str = K.SOURCE_OPTIONS
) -> DataFrame:
    """Calls and puts of many underlyings and expiries to the 22-column chain.

    Both sides carry the snapshot envelope: ``underlying``, ``expiry``,
    ``underlying_price`` and ``snapshot_ts``. A column a side lacks is null.
    """
    sides = [side.withColumn("type", F.lit(kind)) for side, kind in ((calls, "call"), (puts, "put"))]
    return typed_chains_to_long(relaxed_union(*sides), source)


def typed_chains_to_long(contracts: DataFrame, source: str = K.SOURCE_OPTIONS) -> DataFrame:
    """``chains_to_long`` of contracts that carry their side as ``type``."""
    schema = DATASETS["options"].schema
    both = contracts.withColumnsRenamed(_CHAIN_NAMES)
    have = set(both.columns)
    changes = {c: to_decimal6(c) for c in _MONEY if c in have}
    changes.update({c: to_long(c) for c in ("volume", "open_interest") if c in have})
    if "in_the_money" in have:
        changes["in_the_money"] = to_bool("in_the_money")
    changes["underlying"] = F.upper("underlying")
    changes["snapshot_date"] = utc_date("snapshot_ts")
    changes["source"] = F.lit(source)
    changes["last_fetched_at"] = F.col("snapshot_ts")
    return conform(both.withColumns(changes), schema)
