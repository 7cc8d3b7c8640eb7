"""Yield observations and central bank series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.catalog import DATASETS
from tidemark.functions import bind, lenient_date, lenient_number, parse_period
from tidemark.operators.project import between_dates, conform, select_series, with_audit
from tidemark.operators.reshape import map_series_id
from tidemark.sources.landed import is_broken_json, quarantine

_OBSERVATIONS = "observations ARRAY<STRUCT<date: STRING, value: STRING>>"


def _observations() -> Column:
    """Typed observations of a payload; ``bad`` says what is wrong with one."""
    items = F.from_json("raw", _OBSERVATIONS)["observations"]

    def typed(item: Column) -> Column:
        date, text = lenient_date(item["date"]), F.nullif(item["value"], F.lit("."))
        value = text.try_cast("double")
        bad = F.when(date.isNull(), F.lit("bad date")).when(
            text.isNotNull() & value.isNull(), F.lit("bad value")
        )
        return F.struct(date.alias("date"), value.alias("value"), bad.alias("bad"))

    return F.transform(items, typed)


def _first_bad(items: Column) -> Column:
    return F.try_element_at(F.filter(items, lambda o: o["bad"].isNotNull()), F.lit(1))["bad"]


def observations_problem() -> Column:
    """Why an observation payload cannot be used, else null."""
    return F.when(is_broken_json(F.col("raw")), F.lit("not JSON")).otherwise(
        _first_bad(_observations())
    )


def fred_observations(
    landed: DataFrame, start: dt.date | str | None = None, end: dt.date | str | None = None
) -> DataFrame:
    """Observation payloads, one per tenor, to ``tenor, date, value``. "." is a missing value.

    A payload with a bad observation is left out whole; see ``fred_quarantine``.
    """
    sound = bind(_observations(), lambda items: F.when(_first_bad(items).isNull(), items))
    rows = landed.select(F.col("symbol").alias("tenor"), F.inline(sound)).drop("bad")
    return between_dates(rows, start, end)


def fred_quarantine(landed: DataFrame) -> DataFrame:
    return quarantine(landed, observations_problem())


def curve_batch(
    landed: DataFrame,
    component: str,
    batch_ts: dt.datetime | str,
    tenors: Iterable[str] | None = None,
    start: dt.date | str | None = None,
) -> DataFrame:
    """Rows of one curve component, ready to merge.

    A series that failed adds no rows, so it cannot replace stored values.
    """
    mapping = K.CURVES[component]
    wanted = list(mapping) if tenors is None else list(tenors)
    rows = fred_observations(select_series(landed, wanted, "symbol", mapping), start)
    rows = with_audit(map_series_id(rows, mapping), K.SOURCE_FRED, batch_ts, component=component)
    return conform(rows, DATASETS["treasury_constant_maturity"].schema)


def ecb_series(
    table: DataFrame,
    batch_ts: dt.datetime | str,
    series_id: str | Column = "series_id",
    label: str | Column | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """SDMX rows to tidy series; daily and monthly periods may be mixed.

    A table without the two data columns gives no rows. Without a label the
    series id is used.
    """
    schema = DATASETS["ecb_interest_rates"].schema
    if not {"TIME_PERIOD", "OBS_VALUE"} <= set(table.columns):
        return table.sparkSession.createDataFrame([], schema)
    sid = F.col(series_id) if isinstance(series_id, str) else series_id
    name = sid if label is None else (F.col(label) if isinstance(label, str) else label)
    tidy = table.select(
        parse_period("TIME_PERIOD").alias("date"),
        lenient_number("OBS_VALUE").alias("value"),
        name.alias("series_label"),
        sid.alias("series_id"),
    )
    return between_dates(conform(with_audit(tidy, K.SOURCE_ECB, batch_ts), schema), start, end)


def ecb_group(
    table: DataFrame,
    group: str,
    batch_ts: dt.datetime | str,
    items: str | Iterable[str] = "ALL",
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    series_id: str = "KEY",
) -> DataFrame:
    """Interest rates, price indices or money: the chosen series of one group, from one scan."""
    members = K.ECB_GROUPS[group]
    names = list(members) if isinstance(items, str) and items == "ALL" else items
    names = [names] if isinstance(names, str) else list(names)
    chosen = {members[n]: n for n in names}
    labels = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair])
    rows = table.where(F.col(series_id).isin(list(chosen)))
    label = F.element_at(labels, F.col(series_id))
    return ecb_series(rows, batch_ts, series_id, label, start, end)
