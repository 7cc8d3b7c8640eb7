"""From a landing folder to a stored dataset, for every dataset of the catalogue.

The landing folder of a dataset is ``<landing>/<dataset>``. What lies in it:

- curves: one observation payload per file, named by tenor (``10Y.json``);
  term premiums have two folders, ``spot`` and ``forward``;
- central bank groups: SDMX text with ``KEY, TIME_PERIOD, OBS_VALUE``;
- statistical tables: text with dimension and period columns;
- statements, overview, adjusted series, details: one payload per file, named
  by ticker;
- bars, open/close: one JSON object per line with its ``ticker`` (and ``date``);
- listing: one JSON object per line;
- options: one JSON object per contract and line, with the snapshot envelope,
  in the folders ``calls`` and ``puts``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import DATASETS, Dataset
from tidemark.operators.ledger import LEDGER_SCHEMA
from tidemark.operators.reshape import full_curve, single_curve
from tidemark.operators.union import relaxed_union
from tidemark.plans.outcomes import read_ledger, record
from tidemark.plans.rejects import store_rejects
from tidemark.plans.save import read_dataset, save_by_item, save_dataset
from tidemark.sources import bars, fundamentals, options, rates, statistics
from tidemark.sources.files import path_exists
from tidemark.sources.landed import placed, read_landed_table, read_lines, read_payloads

Feed = Callable[[SparkSession, str, "dt.datetime | str"], DataFrame]


@dataclass(frozen=True)
class Landing:
    """How the files of a dataset are read, judged line by line, and shaped.

    ``read`` gives one row per payload: symbol, raw, file, block, row. ``judge`` adds the
    ``reason`` why a payload cannot be used, and may keep what it has parsed for
    ``shape``, which gets the usable ones.
    """

    read: Callable[[SparkSession, str], DataFrame]
    judge: Callable[[DataFrame], DataFrame]
    shape: Callable[[DataFrame, "dt.datetime | str"], DataFrame]


def _reason(problem: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda landed: landed.withColumn("reason", problem())


def _payloads(problem: Callable[[], Column], shape) -> Landing:
    return Landing(read_payloads, _reason(problem), shape)


def _curve(component: str) -> Landing:
    return _payloads(rates.observations_problem, lambda landed, ts: rates.curve_batch(landed, component, ts))


def _sides(*folders: str, read=read_payloads) -> Callable[[SparkSession, str], DataFrame]:
    """Payloads of several folders, with the folder's name as ``side``."""

    def both(spark: SparkSession, folder: str) -> DataFrame:
        return relaxed_union(*[read(spark, f"{folder}/{side}").withColumn("side", F.lit(side)) for side in folders])

    return both


def _term_premiums(landed: DataFrame, ts) -> DataFrame:
    sides = (("spot", "term_premium_spot"), ("forward", "term_premium_forward"))
    return relaxed_union(*[rates.curve_batch(landed.where(F.col("side") == side), c, ts) for side, c in sides])


def _ecb(group: str) -> Feed:
    return lambda spark, folder, ts: rates.ecb_group(read_landed_table(spark, folder), group, ts)


def _statistical(query: Callable) -> Feed:
    return lambda spark, folder, ts: query(read_landed_table(spark, folder), ts)


def _read_symbols(*envelope: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: read_lines(spark, folder, "ticker", *envelope).withColumnRenamed("ticker", "symbol")


def _judge_bars(landed: DataFrame) -> DataFrame:
    parsed = landed.withColumn("bar", bars.parse_bars(F.col("raw")))
    return parsed.withColumns({"symbol": F.col("bar.ticker"), "reason": F.col("bar.reason")})


def _shape_bars(landed: DataFrame, ts) -> DataFrame:
    return bars.shape_bars(landed.where("symbol IS NOT NULL").withColumnRenamed("symbol", "ticker"), ts)


def _shape_open_close(landed: DataFrame, ts) -> DataFrame:
    return bars.open_close(landed.where("symbol IS NOT NULL"), ts, F.col("date"))


_CONTRACT = ("underlying", "expiry", "quick_price", "profile_price", "snapshot_ts")


def _read_contracts(spark: SparkSession, folder: str) -> DataFrame:
    return read_lines(spark, folder, *_CONTRACT).withColumn("symbol", F.col("underlying"))


def _shape_contracts(landed: DataFrame, ts) -> DataFrame:
    prices = {c: F.col(c).try_cast("double") for c in ("quick_price", "profile_price")}
    stamped = F.coalesce(F.col("snapshot_ts").try_cast("timestamp"), F.lit(ts).cast("timestamp"))
    kind = F.when(F.col("side") == "calls", "call").otherwise("put")
    rows = landed.where("underlying IS NOT NULL").withColumns({**prices, "snapshot_ts": stamped, "type": kind})
    return options.typed_option_chain(options.parse_chain(rows))


# Datasets that land as payloads, each judged by itself.
LANDINGS: dict[str, Landing] = {
    "treasury_constant_maturity": _curve("constant_maturity"),
    "gsw_zero_coupon": _curve("zero_coupon"),
    "gsw_forward_rates": _curve("instantaneous_forward"),
    "gsw_term_premiums": Landing(_sides("spot", "forward"), _reason(rates.observations_problem), _term_premiums),
    "daily_bars": Landing(
        lambda spark, folder: placed(spark.read.text(folder)), _judge_bars, _shape_bars
    ),
    "daily_open_close": Landing(_read_symbols("date"), _reason(bars.payload_problem), _shape_open_close),
    "ticker_details": _payloads(bars.payload_problem, bars.ticker_details),
    "ticker_list": Landing(
        lambda spark, folder: read_lines(spark, folder, "market").withColumnRenamed("market", "symbol"),
        _reason(bars.listing_problem), bars.ticker_list,
    ),
    **{
        name: _payloads(fundamentals.statement_problem, lambda landed, ts, n=name: fundamentals.fundamentals(landed, n, ts))
        for name in fundamentals.STATEMENTS
    },
    "overview": _payloads(fundamentals.overview_problem, fundamentals.overview),
    **{
        name: _payloads(fundamentals.adjusted_problem, lambda landed, ts, n=name: fundamentals.adjusted_series(landed, n, ts))
        for name in fundamentals.INTERVALS
    },
    "options": Landing(_sides("calls", "puts", read=_read_contracts), _reason(options.contract_problem), _shape_contracts),
}



def _feed(landing: Landing) -> Feed:
    """The usable rows of a landing, without its rejects."""
    return lambda spark, folder, ts: landing.shape(landing.judge(landing.read(spark, folder)).where("reason IS NULL"), ts)


FEEDS: dict[str, Feed] = {
    **{name: _feed(landing) for name, landing in LANDINGS.items()},
    "ecb_interest_rates": _ecb("interest_rates"),
    "ecb_hicp": _ecb("hicp"),
    "ecb_monetary_aggregates": _ecb("monetary_aggregates"),
    "euro_area_yield_curve": _statistical(statistics.euro_area_yield_curve),
    "gov_bond_yields": _statistical(statistics.gov_bond_yields),
    "eurostat_hicp": _statistical(statistics.hicp),
    "eurostat_gdp": _statistical(statistics.gdp),
}

# Datasets saved together, by source.
BUNDLES: dict[str, tuple[str, ...]] = {
    "curves": (
        "treasury_constant_maturity",
        "gsw_zero_coupon",
        "gsw_forward_rates",
        "gsw_term_premiums",
    ),
    "ecb": ("ecb_interest_rates", "ecb_hicp", "ecb_monetary_aggregates"),
    "eurostat": ("euro_area_yield_curve", "gov_bond_yields", "eurostat_hicp", "eurostat_gdp"),
    "bars": ("daily_bars", "ticker_details", "daily_open_close", "ticker_list"),
    "fundamentals": (*fundamentals.STATEMENTS, "overview", *fundamentals.INTERVALS),
    "options": ("options",),
}


def ingest(
    spark: SparkSession,
    store: str,
    landing: str,
    name: str,
    batch_ts: dt.datetime | str,
    items: str | Iterable[str] = "ALL",
    run_id: str | None = None,
    full_history: bool = False,
) -> DataFrame:
    """Read what has landed for a dataset and save it. Returns its ledger rows.

    ``items`` picks tickers, countries or underlyings. Datasets of many items
    are saved with failures isolated per item, the others as a whole. Every
    item that landed or was asked for has a ledger row: saved, failed with the
    reason, or skipped; payloads that are no rows are kept as rejects. ``full_history`` takes all landed rows in place of those
    from the dataset's start date on.
    """
    dataset = DATASETS[name]
    run_id = run_id or f"{name}-{batch_ts}"
    folder = f"{landing.rstrip('/')}/{name}"
    if not path_exists(spark, folder):
        row = (run_id, name, name, "skipped", "nothing landed")
        return spark.createDataFrame([row], LEDGER_SCHEMA)
    asked = None if items == "ALL" else [i.upper() for i in ([items] if isinstance(items, str) else items)]
    lookback = None if full_history else dataset.lookback_days
    how = LANDINGS.get(name)
    if how is None:
        batch = FEEDS[name](spark, folder, batch_ts)
        return _save(spark, store, dataset, batch, lookback, run_id, asked, None)
    lines = how.read(spark, folder)
    # One pass reads and judges the payloads; rows, rejects and counts are taken from it.
    judged = how.judge(lines).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mine = judged
        if dataset.item_column and asked is not None:
            mine = judged.where(F.upper("symbol").isin(asked))
        store_rejects(judged.select("file", "block", "row"), mine, store, run_id, name)
        batch = how.shape(judged.where("reason IS NULL"), batch_ts)
        return _save(spark, store, dataset, batch, lookback, run_id, asked, mine)
    finally:
        judged.unpersist()


def _save(
    spark: SparkSession,
    store: str,
    dataset: Dataset,
    batch: DataFrame,
    lookback: int | None,
    run_id: str,
    asked: list[str] | None,
    judged: DataFrame | None,
) -> DataFrame:
    """Save a batch, by item where the dataset has items. Returns the ledger rows of the run."""
    name, monthly = dataset.name, dataset.monthly_start
    if not dataset.item_column:
        outcome = save_dataset(spark, store, dataset, batch, lookback, monthly)
        one = spark.createDataFrame([(name, outcome.status, outcome.reason)], "item STRING, status STRING, reason STRING")
        record(one, store, run_id, name)
        return read_ledger(spark, store, run_id)
    if asked is not None:
        batch = batch.where(F.upper(dataset.item_column).isin(asked))
    return save_by_item(spark, store, dataset, batch, lookback, run_id, monthly, _expected(spark, judged, asked))


def _expected(spark: SparkSession, judged: DataFrame | None, asked: list[str] | None) -> DataFrame | None:
    """(item, landed, rejected, problem) of what landed or was asked for.

    A line without a symbol is listed as "?" where it is rejected, so that broken text is not lost from sight.
    """
    parts = []
    if judged is not None:
        symbol = F.coalesce(F.upper("symbol"), F.when(F.col("reason").isNotNull(), F.lit("?")))
        parts.append(
            judged.select(symbol.alias("item"), "reason").where(F.col("item").isNotNull()).groupBy("item").agg(
                F.count(F.lit(1)).alias("landed"), F.count("reason").alias("rejected"), F.min("reason").alias("problem")
            )
        )
    if asked is not None:
        parts.append(spark.createDataFrame([(i, None, None, None) for i in asked], "item STRING, landed BIGINT, rejected BIGINT, problem STRING"))
    return relaxed_union(*parts) if parts else None


def ingest_bundle(
    spark: SparkSession, store: str, landing: str, bundle: str, batch_ts: dt.datetime | str
) -> DataFrame:
    """Ingest the datasets of one source; a failure does not stop the others."""
    ledgers = []
    for name in BUNDLES[bundle]:
        run_id = f"{bundle}-{batch_ts}"
        try:
            ledgers.append(ingest(spark, store, landing, name, batch_ts, run_id=f"{run_id}-{name}"))
        except Exception as error:  # kept as the reason; the next dataset goes on
            row = (f"{run_id}-{name}", name, name, "failed", str(error).splitlines()[0])
            ledgers.append(spark.createDataFrame([row], LEDGER_SCHEMA))
    return relaxed_union(*ledgers)


def read_curve(spark: SparkSession, store: str, name: str, wide: bool = True) -> DataFrame:
    """A stored curve, wide by tenor or as stored."""
    rows = read_dataset(spark, store, name)
    if not wide:
        return rows
    if name == "gsw_term_premiums":
        return full_curve(rows, ("term_premium_spot", "term_premium_forward"))
    component = {
        "treasury_constant_maturity": "constant_maturity",
        "gsw_zero_coupon": "zero_coupon",
        "gsw_forward_rates": "instantaneous_forward",
    }[name]
    return single_curve(rows, component)
