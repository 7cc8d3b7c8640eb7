"""Statistical office tables: one column per period, dimensions in the rest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.catalog import DATASETS
from tidemark.operators.project import conform, dimension_filter
from tidemark.operators.reshape import periods_to_long


def _geo() -> Column:
    return F.col(f"`{K.GEO_COLUMN}`")


def dataset_rows(
    wide: DataFrame,
    indicator: str,
    batch_ts: dt.datetime | str,
    filters: Mapping[str, str | Iterable[str]] | None = None,
    extra: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """Filter by dimension, then turn periods into rows. One scan, however many codes."""
    named = {K.GEO_COLUMN if d == "geo" else d: v for d, v in (filters or {}).items()}
    return periods_to_long(dimension_filter(wide, named), indicator, batch_ts, extra)


def euro_area_yield_curve(
    wide: DataFrame,
    batch_ts: dt.datetime | str,
    curve_type: str = "PAR",
    bond_type: str = "CGB_EA",
    maturities: Iterable[str] | None = None,
) -> DataFrame:
    filters = {
        "geo": "EA",
        "yld_curv": curve_type,
        "bonds": bond_type,
        "maturity": list(maturities or K.CURVE_MATURITIES),
    }
    extra = {"curve_type": F.col("yld_curv"), "bond_type": F.col("bonds"), "country": _geo()}
    rows = dataset_rows(
        wide, f"euro_area_yield_curve_{curve_type.lower()}", batch_ts, filters, extra
    )
    return conform(rows, DATASETS["euro_area_yield_curve"].schema)


def gov_bond_yields(
    wide: DataFrame, batch_ts: dt.datetime | str, countries: Iterable[str] | None = None
) -> DataFrame:
    filters = {"geo": list(countries or K.BOND_COUNTRIES), "int_rt": "GBY_LT"}
    extra = {"country": _geo(), "maturity": "Y10"}
    rows = dataset_rows(wide, "gov_bond_yield_10y", batch_ts, filters, extra)
    return conform(rows, DATASETS["gov_bond_yields"].schema)


def hicp(
    wide: DataFrame, batch_ts: dt.datetime | str, countries: Iterable[str] | None = None
) -> DataFrame:
    filters = {"geo": list(countries or K.MACRO_AREAS), "coicop": "CP00"}
    extra = {"country": _geo(), "item": "all_items"}
    rows = dataset_rows(wide, "hicp_all_items", batch_ts, filters, extra)
    return conform(rows, DATASETS["eurostat_hicp"].schema)


def gdp(
    wide: DataFrame, batch_ts: dt.datetime | str, countries: Iterable[str] | None = None
) -> DataFrame:
    filters = {
        "geo": list(countries or K.MACRO_AREAS),
        "na_item": "B1GQ",
        "unit": "CLV10_MNAC",
        "s_adj": "SCA",
    }
    rows = dataset_rows(wide, "gdp_volume_sa", batch_ts, filters, {"country": _geo()})
    return conform(rows, DATASETS["eurostat_gdp"].schema)
