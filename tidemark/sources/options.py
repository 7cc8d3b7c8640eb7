"""Option-chain snapshots of many underlyings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import DATASETS
from tidemark.functions import first_available, lenient_date, to_decimal6
from tidemark.operators.joins import requested_vs_available
from tidemark.operators.merge import dedupe_grain
from tidemark.operators.reshape import typed_chains_to_long
from tidemark.operators.union import relaxed_union
from tidemark.sources.landed import is_broken_json

CHAIN_PAYLOAD = (
    "contractSymbol STRING, lastTradeDate TIMESTAMP, strike DOUBLE, lastPrice DOUBLE, "
    "bid DOUBLE, ask DOUBLE, change DOUBLE, percentChange DOUBLE, volume DOUBLE, "
    "openInterest DOUBLE, impliedVolatility DOUBLE, inTheMoney BOOLEAN, contractSize STRING, "
    "currency STRING"
)


def _requested(contracts: DataFrame, expiries: Iterable[str] | DataFrame | None) -> DataFrame:
    """Rows of the expiries asked for (all where None); a long request is a DataFrame with an ``expiry`` column."""
    if isinstance(expiries, DataFrame):
        return contracts.join(expiries, "expiry", "left_semi")
    if expiries is not None:
        return contracts.where(F.col("expiry").isin([F.lit(e).cast("date") for e in expiries]))
    return contracts


def parse_chain(landed: DataFrame, expiries: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Contract payloads, one JSON object per row, next to their snapshot envelope.

    The envelope has ``underlying``, ``expiry`` (text), ``quick_price``,
    ``profile_price`` and ``snapshot_ts``; the quick quote is preferred. Contracts
    with a bad expiry or a broken payload are left out (``contract_problem``). A
    ``type`` (side) is kept. What the envelope can tell (bad expiries, ``expiries``
    that nobody asked for) is filtered before a payload is parsed.
    """
    spot = first_available(to_decimal6("quick_price"), to_decimal6("profile_price"))
    envelope = ["underlying", "expiry", "underlying_price", "snapshot_ts"]
    envelope += [c for c in ("type",) if c in landed.columns]
    dated = landed.withColumns({"expiry": lenient_date("expiry"), "underlying_price": spot})
    wanted = _requested(dated.where(F.col("expiry").isNotNull()), expiries)
    # Unnested, so that the test of the symbol cannot be pushed below the parse and repeat it.
    contract = F.inline(F.array(F.from_json("raw", CHAIN_PAYLOAD)))
    return wanted.select(*envelope, contract).where(F.col("contractSymbol").isNotNull())


def contract_problem() -> Column:
    """Why a contract cannot be used, else null: one bad contract does not stop its chain."""
    symbol = F.get_json_object("raw", "$.contractSymbol")
    return (
        F.when(is_broken_json(F.col("raw")), F.lit("not JSON"))
        .when(symbol.isNull(), F.lit("no contract symbol"))
        .when(lenient_date("expiry").isNull(), F.lit("bad expiry"))
    )


def option_chain(
    calls: DataFrame, puts: DataFrame, expiries: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """Chains of all expiries, or of those requested, one row per contract and snapshot.

    A long request comes as a DataFrame with an ``expiry`` column.
    """
    sides = [side.withColumn("type", F.lit(kind)) for side, kind in ((calls, "call"), (puts, "put"))]
    return typed_option_chain(relaxed_union(*sides), expiries)


def typed_option_chain(
    contracts: DataFrame, expiries: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """``option_chain`` of contracts that carry their side as ``type``: one parse, one join."""
    contracts = _requested(contracts, expiries)
    return dedupe_grain(typed_chains_to_long(contracts), DATASETS["options"].keys)


def missing_expiries(requested: DataFrame, calls: DataFrame, puts: DataFrame) -> DataFrame:
    """Requested ``(underlying, expiry)`` pairs that no chain offers."""
    key = ["underlying", "expiry"]
    offered = calls.select(*key).unionByName(puts.select(*key))
    return requested_vs_available(requested, offered, key)[1]
