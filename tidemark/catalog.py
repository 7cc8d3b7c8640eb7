"""Dataset catalogue: schemas, keys, buckets, gates and upkeep policies.

A ``Dataset`` says everything the jobs need, so one code path serves all of
them. Stored tables are bucketed by time (or by country / market) and sorted
by the lookup columns inside each bucket. A daily batch therefore rewrites
only the newest buckets, however many tickers there are, and a lookup by
ticker is served by the min/max statistics of the sorted files. Buckets are as
wide as the volume asks for: years for series, months for bars, days for option
chains.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.functions.buckets import time_bucket


_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL(18,6)": T.DecimalType(18, 6),
    "MAP<STRING, STRING>": T.MapType(T.StringType(), T.StringType()),
}


def table_schema(*columns: str) -> T.StructType:
    """Schema of "name TYPE" texts. Unlike a DDL string it needs no session."""
    pairs = [c.split(" ", 1) for c in columns]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_AUDIT = ("source STRING", "last_fetched_at TIMESTAMP")
_STATEMENT_HEAD = (
    "ticker STRING",
    "report_type STRING",
    "fiscal_date_ending DATE",
    "reported_currency STRING",
)
_EXTRA = "extra MAP<STRING, STRING>"


@dataclass(frozen=True)
class Gate:
    """What a dataset must satisfy before it is published."""

    required: tuple[str, ...] = ("date",)
    not_all_null: tuple[str, ...] = ("date",)
    date_column: str | None = "date"
    min_rows: int = 1
    max_rows: int | None = None
    min_date: str | None = None
    max_date: str | None = None


# Statements, profiles and listings only have to hold rows.
NOT_EMPTY = Gate(required=(), not_all_null=(), date_column=None)

OPTION_KEYS = (
    "underlying",
    "type",
    "expiry",
    "contract_symbol",
    "strike",
    "snapshot_ts",
    "snapshot_date",
)
OPTIONS_GATE = Gate(required=OPTION_KEYS, not_all_null=OPTION_KEYS, date_column="snapshot_date")


@dataclass(frozen=True)
class Dataset:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    gate: Gate = field(default_factory=Gate)
    date_column: str | None = "date"
    # Time width of a bucket, or None when ``bucket_column`` or nothing splits the table.
    bucket_width: str | None = "month"
    bucket_column: str | None = None
    # The column a per-key save isolates failures by ("ticker", "country", ...).
    item_column: str | None = None
    lookback_days: int | None = None
    # Whether the start date of an increment is cut to its month.
    monthly_start: bool = False
    # Sort order inside a bucket, for lookups.
    cluster_by: tuple[str, ...] = ()
    bloom_columns: tuple[str, ...] = ()

    def bucket_expr(self) -> Column:
        """Text of the bucket a row belongs to; also the partition directory."""
        if self.bucket_width:
            return time_bucket(self.bucket_width, F.col(self.date_column)).cast("string")
        if self.bucket_column:
            return F.col(self.bucket_column).cast("string")
        return F.lit("all")

    @property
    def time_bucketed(self) -> bool:
        return self.bucket_width is not None

    @property
    def sort_columns(self) -> tuple[str, ...]:
        """Sort order inside a bucket: lookup columns first, then the rest of the key."""
        return self.cluster_by + tuple(k for k in self.keys if k not in self.cluster_by)

    @property
    def write_keys(self) -> tuple[str, ...]:
        """The key in the order rows are sorted by."""
        return tuple(c for c in self.sort_columns if c in self.keys)


def _curve(name: str) -> Dataset:
    return Dataset(
        name,
        table_schema(
            "date DATE",
            "tenor STRING",
            "value DOUBLE",
            "fred_series_id STRING",
            "component STRING",
            *_AUDIT,
        ),
        keys=("date", "tenor", "fred_series_id"),
        bucket_width="year",
        lookback_days=7,
        cluster_by=("tenor", "fred_series_id", "date"),
    )


def _ecb(name: str) -> Dataset:
    return Dataset(
        name,
        table_schema("date DATE", "value DOUBLE", "series_label STRING", "series_id STRING", *_AUDIT),
        keys=("date", "series_label"),
        bucket_width="year",
        lookback_days=7,
        cluster_by=("series_label", "date"),
    )


def _statement(name: str, *columns: str) -> Dataset:
    return Dataset(
        name,
        table_schema(*_STATEMENT_HEAD, *columns, *_AUDIT, _EXTRA),
        keys=("ticker", "fiscal_date_ending", "report_type"),
        gate=NOT_EMPTY,
        date_column="fiscal_date_ending",
        bucket_width="year",
        item_column="ticker",
        cluster_by=("ticker", "fiscal_date_ending"),
    )


def _adjusted(name: str, width: str) -> Dataset:
    return Dataset(
        name,
        table_schema(
            "ticker STRING",
            "date DATE",
            "interval STRING",
            "open DOUBLE",
            "high DOUBLE",
            "low DOUBLE",
            "close DOUBLE",
            "adjusted_close DOUBLE",
            "volume DOUBLE",
            "dividend_amount DOUBLE",
            "split_coefficient DOUBLE",
            *_AUDIT,
            _EXTRA,
        ),
        keys=("ticker", "date"),
        bucket_width=width,
        item_column="ticker",
        cluster_by=("ticker", "date"),
    )


_DATASETS = [
    _curve("treasury_constant_maturity"),
    _curve("gsw_zero_coupon"),
    _curve("gsw_forward_rates"),
    _curve("gsw_term_premiums"),
    _ecb("ecb_interest_rates"),
    _ecb("ecb_hicp"),
    _ecb("ecb_monetary_aggregates"),
    Dataset(
        "euro_area_yield_curve",
        table_schema(
            "date DATE",
            "value DOUBLE",
            "maturity STRING",
            "curve_type STRING",
            "bond_type STRING",
            "country STRING",
            "freq STRING",
            "indicator STRING",
            *_AUDIT,
        ),
        keys=("date", "maturity", "curve_type", "bond_type", "country"),
        lookback_days=7,
        monthly_start=True,
        bucket_width="year",
        cluster_by=("maturity", "curve_type", "date"),
    ),
    Dataset(
        "gov_bond_yields",
        table_schema(
            "date DATE",
            "value DOUBLE",
            "country STRING",
            "maturity STRING",
            "int_rt STRING",
            "freq STRING",
            "indicator STRING",
            *_AUDIT,
        ),
        keys=("country", "date", "int_rt"),
        bucket_width=None,
        bucket_column="country",
        lookback_days=7,
        monthly_start=True,
        item_column="country",
        cluster_by=("date",),
    ),
    Dataset(
        "eurostat_hicp",
        table_schema(
            "date DATE",
            "value DOUBLE",
            "country STRING",
            "item STRING",
            "unit STRING",
            "coicop STRING",
            "freq STRING",
            "indicator STRING",
            *_AUDIT,
        ),
        keys=("date", "country", "item", "unit"),
        bucket_width="year",
        lookback_days=7,
        monthly_start=True,
        cluster_by=("country", "item", "date"),
    ),
    Dataset(
        "eurostat_gdp",
        table_schema(
            "date DATE",
            "value DOUBLE",
            "country STRING",
            "na_item STRING",
            "unit STRING",
            "s_adj STRING",
            "freq STRING",
            "indicator STRING",
            *_AUDIT,
        ),
        keys=("date", "country", "na_item", "unit", "s_adj"),
        bucket_width="year",
        lookback_days=7,
        monthly_start=True,
        cluster_by=("country", "date"),
    ),
    Dataset(
        "daily_bars",
        table_schema(
            "ticker STRING",
            "date DATE",
            "open DOUBLE",
            "high DOUBLE",
            "low DOUBLE",
            "close DOUBLE",
            "volume DOUBLE",
            "vwap DOUBLE",
            "transactions BIGINT",
            *_AUDIT,
        ),
        keys=("ticker", "date"),
        item_column="ticker",
        cluster_by=("ticker", "date"),
    ),
    Dataset(
        "daily_open_close",
        table_schema(
            "ticker STRING",
            "date DATE",
            "open DOUBLE",
            "high DOUBLE",
            "low DOUBLE",
            "close DOUBLE",
            "volume DOUBLE",
            "vwap DOUBLE",
            "after_hours DOUBLE",
            "pre_market DOUBLE",
            *_AUDIT,
        ),
        keys=("ticker", "date"),
        item_column="ticker",
        cluster_by=("ticker", "date"),
    ),
    Dataset(
        "ticker_details",
        table_schema(
            "ticker STRING",
            "name STRING",
            "market STRING",
            "locale STRING",
            "primary_exchange STRING",
            "type STRING",
            "active BOOLEAN",
            "currency_name STRING",
            "cik STRING",
            "market_cap DOUBLE",
            "list_date STRING",
            "total_employees BIGINT",
            "address STRING",
            "branding STRING",
            _EXTRA,
            *_AUDIT,
        ),
        keys=("ticker",),
        gate=NOT_EMPTY,
        date_column=None,
        bucket_width=None,
        item_column="ticker",
    ),
    Dataset(
        "ticker_list",
        table_schema(
            "ticker STRING",
            "market STRING",
            "name STRING",
            "locale STRING",
            "primary_exchange STRING",
            "type STRING",
            "active BOOLEAN",
            "currency_name STRING",
            _EXTRA,
            *_AUDIT,
        ),
        keys=("market", "ticker"),
        gate=NOT_EMPTY,
        date_column=None,
        bucket_width=None,
        bucket_column="market",
        item_column="market",
    ),
    _statement(
        "income_statement",
        "gross_profit DOUBLE",
        "total_revenue DOUBLE",
        "operating_income DOUBLE",
        "net_income DOUBLE",
        "ebit DOUBLE",
        "ebitda DOUBLE",
    ),
    _statement(
        "balance_sheet",
        "total_assets DOUBLE",
        "total_liabilities DOUBLE",
        "total_shareholder_equity DOUBLE",
    ),
    _statement(
        "cash_flow",
        "operating_cashflow DOUBLE",
        "capital_expenditures DOUBLE",
        "dividend_payout DOUBLE",
        "net_income DOUBLE",
    ),
    _statement(
        "earnings",
        "reported_eps DOUBLE",
        "reported_date STRING",
        "estimated_eps DOUBLE",
        "surprise DOUBLE",
        "surprise_percentage DOUBLE",
        "report_time STRING",
    ),
    Dataset(
        "overview",
        table_schema(
            "ticker STRING",
            "asset_type STRING",
            "name STRING",
            "description STRING",
            "cik STRING",
            "exchange STRING",
            "currency STRING",
            "country STRING",
            "sector STRING",
            "industry STRING",
            "market_capitalization BIGINT",
            *_AUDIT,
            _EXTRA,
        ),
        keys=("ticker",),
        gate=NOT_EMPTY,
        date_column=None,
        bucket_width=None,
        item_column="ticker",
    ),
    _adjusted("daily_adjusted", "month"),
    _adjusted("weekly_adjusted", "quarter"),
    _adjusted("monthly_adjusted", "year"),
    Dataset(
        "options",
        table_schema(
            "underlying STRING",
            "type STRING",
            "expiry DATE",
            "contract_symbol STRING",
            "strike DECIMAL(18,6)",
            "currency STRING",
            "last_price DECIMAL(18,6)",
            "bid DECIMAL(18,6)",
            "ask DECIMAL(18,6)",
            "change DECIMAL(18,6)",
            "percent_change DOUBLE",
            "volume BIGINT",
            "open_interest BIGINT",
            "implied_volatility DOUBLE",
            "in_the_money BOOLEAN",
            "contract_size STRING",
            "last_trade_date TIMESTAMP",
            "underlying_price DECIMAL(18,6)",
            "snapshot_ts TIMESTAMP",
            "snapshot_date DATE",
            *_AUDIT,
        ),
        keys=("underlying", "contract_symbol", "expiry", "type", "snapshot_ts"),
        gate=OPTIONS_GATE,
        date_column="snapshot_date",
        bucket_width="day",
        item_column="underlying",
        cluster_by=("underlying", "type", "contract_symbol"),
        bloom_columns=("contract_symbol",),
    ),
]

DATASETS: dict[str, Dataset] = {d.name: d for d in _DATASETS}


@dataclass(frozen=True)
class TableSpec:
    """A typed load target: the declared table, its constraints and its upkeep."""

    name: str
    datasets: tuple[str, ...]
    schema: T.StructType
    primary_key: tuple[str, ...]
    source_default: str
    require_date: bool = True
    mode: str = "replace"
    date_column: str | None = "date"
    bucket_width: str | None = None
    # Ages are in months, or days where ``compact_unit`` says so.
    retain_months: int | None = None
    compact_after: int | None = None
    compact_unit: str = "months"
    segment_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()

    def dataset(self) -> Dataset:
        """The stored form of the table."""
        return Dataset(
            self.name,
            self.schema,
            keys=self.primary_key,
            gate=NOT_EMPTY,
            date_column=self.date_column,
            bucket_width=self.bucket_width,
            cluster_by=self.segment_by,
            bloom_columns=("contract_symbol",) if self.name == "yfinance_options" else (),
        )


def _table(name, datasets, columns, primary_key, source, **kw) -> TableSpec:
    not_null = kw.pop("not_null", ())
    return TableSpec(
        name,
        tuple(datasets),
        table_schema(*columns, *_AUDIT),
        tuple(primary_key),
        source,
        not_null=tuple(primary_key) + tuple(not_null),
        **kw,
    )


_TIME = dict(retain_months=120, compact_after=12)
_SERIES = ("date DATE", "value DOUBLE", "series_label STRING", "series_id STRING")

_TABLES = [
    _table(
        "fred_yield_curves",
        (
            "treasury_constant_maturity",
            "gsw_zero_coupon",
            "gsw_forward_rates",
            "gsw_term_premiums",
        ),
        (
            "date DATE",
            "tenor STRING",
            "value DOUBLE",
            "fred_series_id STRING",
            "component STRING",
        ),
        ("date", "fred_series_id"),
        K.SOURCE_FRED,
        not_null=("tenor",),
        bucket_width="month",
        retain_months=120,
        compact_after=6,
        segment_by=("component", "fred_series_id"),
    ),
    _table(
        "ecb_key_rates",
        ("ecb_interest_rates",),
        _SERIES,
        ("date", "series_id"),
        K.SOURCE_ECB,
        bucket_width="quarter",
        segment_by=("series_label",),
        **_TIME,
    ),
    _table(
        "ecb_hicp",
        ("ecb_hicp",),
        _SERIES,
        ("date", "series_id"),
        K.SOURCE_ECB,
        bucket_width="quarter",
        segment_by=("series_label",),
        **_TIME,
    ),
    _table(
        "ecb_monetary_aggregates",
        ("ecb_monetary_aggregates",),
        _SERIES,
        ("date", "series_id"),
        K.SOURCE_ECB,
        bucket_width="quarter",
        segment_by=("series_label",),
        **_TIME,
    ),
    _table(
        "eurostat_yield_curve",
        ("euro_area_yield_curve",),
        (
            "date DATE",
            "maturity STRING",
            "value DOUBLE",
            "curve_type STRING",
            "bond_type STRING",
            "country STRING",
            "indicator STRING",
        ),
        ("date", "maturity", "curve_type", "bond_type", "country"),
        K.SOURCE_EUROSTAT,
        bucket_width="quarter",
        segment_by=("maturity", "curve_type"),
        **_TIME,
    ),
    _table(
        "eurostat_hicp",
        ("eurostat_hicp",),
        (
            "date DATE",
            "country STRING",
            "value DOUBLE",
            "item STRING",
            "unit STRING",
            "indicator STRING",
        ),
        ("date", "country", "item", "unit"),
        K.SOURCE_EUROSTAT,
        bucket_width="quarter",
        segment_by=("country", "item"),
        **_TIME,
    ),
    _table(
        "eurostat_gdp",
        ("eurostat_gdp",),
        ("date DATE", "country STRING", "value DOUBLE", "indicator STRING"),
        ("date", "country"),
        K.SOURCE_EUROSTAT,
        bucket_width="year",
        segment_by=("country",),
        **_TIME,
    ),
    _table(
        "market_data_daily",
        ("daily_bars",),
        (
            "ticker STRING",
            "date DATE",
            "open DOUBLE",
            "high DOUBLE",
            "low DOUBLE",
            "close DOUBLE",
            "volume DOUBLE",
            "vwap DOUBLE",
            "transactions BIGINT",
        ),
        ("ticker", "date"),
        K.SOURCE_BARS,
        bucket_width="month",
        retain_months=24,
        compact_after=3,
        segment_by=("ticker",),
    ),
    _table(
        "fundamentals_income_stmt",
        ("income_statement",),
        (
            "ticker STRING",
            "fiscal_date_ending DATE",
            "report_type STRING",
            "reported_currency STRING",
            "gross_profit DOUBLE",
            "total_revenue DOUBLE",
            "net_income DOUBLE",
            "ebitda DOUBLE",
        ),
        ("ticker", "fiscal_date_ending", "report_type"),
        K.SOURCE_FUNDAMENTALS,
        require_date=False,
        date_column="fiscal_date_ending",
    ),
    _table(
        "fundamentals_overview",
        ("overview",),
        (
            "ticker STRING",
            "asset_type STRING",
            "name STRING",
            "description STRING",
            "cik STRING",
            "exchange STRING",
            "currency STRING",
            "country STRING",
            "sector STRING",
            "industry STRING",
            "market_capitalization BIGINT",
        ),
        ("ticker",),
        K.SOURCE_FUNDAMENTALS,
        require_date=False,
        date_column=None,
    ),
    TableSpec(
        "yfinance_options",
        ("options",),
        DATASETS["options"].schema,
        ("underlying", "expiry", "type", "contract_symbol", "snapshot_ts"),
        K.SOURCE_OPTIONS,
        require_date=False,
        mode="upsert",
        date_column="snapshot_date",
        bucket_width="day",
        retain_months=60,
        compact_after=7,
        compact_unit="days",
        segment_by=("underlying", "type"),
        order_by=("snapshot_ts DESC",),
        not_null=(
            "underlying",
            "expiry",
            "type",
            "contract_symbol",
            "snapshot_ts",
            "strike",
            "snapshot_date",
        ),
    ),
]

TABLES: dict[str, TableSpec] = {t.name: t for t in _TABLES}
