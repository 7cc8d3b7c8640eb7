"""Every dataset of the catalogue, from landed files to the store."""

from __future__ import annotations

import json

import pytest

from tests.conftest import day
from tidemark import constants as K
from tidemark.catalog import DATASETS
from tidemark.plans.outcomes import read_outcomes
from tidemark.plans.rejects import read_rejects
from tidemark.plans.feeds import BUNDLES, FEEDS, ingest, ingest_bundle, read_curve
from tidemark.plans.save import read_dataset

BATCH = "2024-06-01 00:00:00"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text if isinstance(text, str) else json.dumps(text))


def observed(value):
    return {"observations": [{"date": "2024-01-02", "value": value}, {"date": "2024-01-03", "value": "."}]}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    put(root / "treasury_constant_maturity/1M.json", observed("4.5"))
    put(root / "treasury_constant_maturity/10Y.json", observed("4.1"))
    put(root / "treasury_constant_maturity/30Y.json", '{"observations":[')
    put(root / "gsw_zero_coupon/5Y.json", observed("3.9"))
    put(root / "gsw_forward_rates/5Y.json", observed("3.8"))
    put(root / "gsw_term_premiums/spot/5Y.json", observed("0.1"))
    put(root / "gsw_term_premiums/forward/5Y.json", observed("0.2"))
    for group, members in K.ECB_GROUPS.items():
        lines = [f"{key},2024-0{i},{i}.5" for i, key in enumerate(members.values(), 1)]
        put(root / f"ecb_{group}/data.csv", "KEY,TIME_PERIOD,OBS_VALUE\n" + "\n".join(lines))
    geo = K.GEO_COLUMN
    put(root / "euro_area_yield_curve/d.csv", f"freq,yld_curv,bonds,maturity,{geo},2024-01\nM,PAR,CGB_EA,Y10,EA,2.5\nM,PAR,CGB_EA,Y7,EA,2.4\n")
    put(root / "gov_bond_yields/d.csv", f"freq,int_rt,{geo},2024-01\nM,GBY_LT,DE,2.1\nM,GBY_LT,FR,2.6\n")
    put(root / "eurostat_hicp/d.csv", f"freq,unit,coicop,{geo},2024-01\nM,I15,CP00,DE,120\n")
    put(root / "eurostat_gdp/d.csv", f"freq,unit,s_adj,na_item,{geo},2024-Q1\nQ,CLV10_MNAC,SCA,B1GQ,DE,800\n")
    bar = {"ticker": "aapl", "timestamp": 1704067200000, "open": 1, "close": 2}
    put(root / "daily_bars/b.json", json.dumps(bar) + "\n" + json.dumps({**bar, "ticker": "msft"}))
    put(root / "daily_open_close/b.json", {"ticker": "aapl", "date": "2024-01-02", "open": 1.0})
    put(root / "ticker_details/aapl.json", {"name": "Apple"})
    put(root / "ticker_list/l.json", {"ticker": "AAPL", "market": "stocks"})
    report = {"fiscalDateEnding": "2024-03-31", "netIncome": "5", "reportedEPS": "1.5"}
    for name in ("income_statement", "balance_sheet", "cash_flow"):
        put(root / f"{name}/ibm.json", {"annualReports": [report]})
    put(root / "earnings/ibm.json", {"annualEarnings": [report]})
    put(root / "overview/ibm.json", {"Symbol": "IBM", "Name": "IBM"})
    for name in ("daily_adjusted", "weekly_adjusted", "monthly_adjusted"):
        put(root / f"{name}/ibm.json", {"Time Series": {"2024-01-02": {"1. open": "1"}}})
    contract = {"underlying": "aapl", "expiry": "2026-06-15", "quick_price": 220.5, "contractSymbol": "C1", "strike": 260.0}
    put(root / "options/calls/c.json", contract)
    put(root / "options/puts/p.json", {**contract, "contractSymbol": "P1"})
    return str(root)


def test_every_dataset_has_a_feed_and_a_bundle():
    assert set(FEEDS) == set(DATASETS)
    assert sorted(n for names in BUNDLES.values() for n in names) == sorted(DATASETS)


@pytest.mark.parametrize("bundle", sorted(BUNDLES))
def test_bundle(spark, landing, tmp_path, bundle):
    store = str(tmp_path)
    ledger = ingest_bundle(spark, store, landing, bundle, BATCH).collect()
    assert {r["status"] for r in ledger} == {"saved"}, ledger
    for name in BUNDLES[bundle]:
        stored = read_dataset(spark, store, name)
        assert stored.count() > 0, name
        assert stored.dtypes == spark.createDataFrame([], DATASETS[name].schema).dtypes, name


def test_curves_read_back_wide(spark, landing, tmp_path):
    store = str(tmp_path)
    ingest_bundle(spark, store, landing, "curves", BATCH)
    wide = read_curve(spark, store, "treasury_constant_maturity").orderBy("date").collect()
    assert [(r["date"], r["1M"], r["10Y"], r["30Y"]) for r in wide] == [
        (day("2024-01-02"), 4.5, 4.1, None),
        (day("2024-01-03"), None, None, None),
    ]
    premiums = read_curve(spark, store, "gsw_term_premiums").orderBy("date").first()
    assert (premiums["TP_5Y"], premiums["TPFWD_5Y"]) == (0.1, 0.2)
    assert read_curve(spark, store, "gsw_zero_coupon", wide=False).count() == 2


def test_items_can_be_picked(spark, landing, tmp_path):
    ledger = ingest(spark, str(tmp_path), landing, "daily_bars", BATCH, items=["msft"]).collect()
    assert [(r["item"], r["status"]) for r in ledger] == [("MSFT", "saved")]
    assert read_dataset(spark, str(tmp_path), "daily_bars", key="aapl").count() == 0


def test_nothing_landed(spark, tmp_path):
    row = ingest(spark, str(tmp_path), str(tmp_path / "none"), "daily_bars", BATCH).first()
    assert (row["status"], row["reason"]) == ("skipped", "nothing landed")


def test_ingest_twice_changes_nothing(spark, landing, tmp_path):
    store = str(tmp_path)
    for _ in range(2):
        ingest(spark, store, landing, "options", BATCH)
    rows = read_dataset(spark, store, "options")
    assert sorted(r["contract_symbol"] for r in rows.collect()) == ["C1", "P1"]


def ledger_of(rows) -> dict:
    return {r["item"]: (r["status"], r["reason"]) for r in rows.collect()}


def test_every_symbol_has_a_ledger_row(spark, tmp_path):
    bar = {"timestamp": 1704067200000, "open": 1, "close": 2}
    lines = [{**bar, "ticker": "a"}, {"ticker": "c", "open": 1}, {"ticker": "n", "Note": "limit"}]
    put(tmp_path / "landing/daily_bars/b.json", "\n".join(map(json.dumps, lines)) + '\n{"ticker": "b", "op\n')
    whole = ingest(spark, f"{tmp_path}/one", f"{tmp_path}/landing", "daily_bars", BATCH)
    assert ledger_of(whole) == {
        "A": ("saved", None), "C": ("failed", "no timestamp"), "N": ("failed", "limit"), "?": ("failed", "not JSON"),
    }
    some = ingest(spark, f"{tmp_path}/two", f"{tmp_path}/landing", "daily_bars", BATCH, items=["a", "C", "missing"])
    assert ledger_of(some) == {
        "A": ("saved", None), "C": ("failed", "no timestamp"), "MISSING": ("skipped", "no rows"),
    }


def test_refused_statements_and_bad_contracts_are_reported(spark, tmp_path):
    put(tmp_path / "landing/income_statement/ibm.json", {"Note": "limit"})
    rows = ingest(spark, f"{tmp_path}/s", f"{tmp_path}/landing", "income_statement", BATCH)
    assert ledger_of(rows) == {"IBM": ("failed", "limit")}
    good = {"underlying": "aaa", "expiry": "2026-06-15", "contractSymbol": "C1", "strike": 1.0}
    bad = {**good, "underlying": "bbb", "expiry": "soon"}
    put(tmp_path / "landing/options/calls/c.json", json.dumps(good) + "\n" + json.dumps(bad))
    put(tmp_path / "landing/options/puts/p.json", {**good, "contractSymbol": "P1"})
    rows = ingest(spark, f"{tmp_path}/s", f"{tmp_path}/landing", "options", BATCH)
    assert ledger_of(rows) == {"AAA": ("saved", None), "BBB": ("failed", "bad expiry")}


def test_a_listing_is_kept_whole_and_found_by_market(spark, tmp_path):
    lines = [{"ticker": f"T{n:04d}", "market": "stocks"} for n in range(3000)] + [{"ticker": "O", "market": "otc"}]
    put(tmp_path / "landing/ticker_list/l.json", "\n".join(map(json.dumps, lines)))
    ingest(spark, f"{tmp_path}/s", f"{tmp_path}/landing", "ticker_list", BATCH)
    assert read_dataset(spark, f"{tmp_path}/s", "ticker_list").count() == 3001
    rows = ingest(spark, f"{tmp_path}/t", f"{tmp_path}/landing", "ticker_list", BATCH, items=["stocks"])
    assert [tuple(r)[2:] for r in rows.collect() if r["item"] == "stocks"] == [("stocks", "saved", None)]
    assert read_dataset(spark, f"{tmp_path}/t", "ticker_list").count() == 3000


def test_statistical_sets_start_with_a_month(spark, tmp_path):
    def land(name: str, *values: tuple[str, int]) -> None:
        header = f"freq,unit,coicop,{K.GEO_COLUMN}," + ",".join(m for m, _ in values)
        put(tmp_path / f"{name}/eurostat_hicp/d.csv", header + "\nM,I15,CP00,DE," + ",".join(str(v) for _, v in values) + "\n")

    land("one", ("2024-01", 1), ("2024-02", 1), ("2024-03", 1))
    land("two", ("2024-01", 2), ("2024-02", 2), ("2024-03", 2), ("2024-04", 2))
    store = f"{tmp_path}/s"

    def values() -> list:
        rows = read_dataset(spark, store, "eurostat_hicp").orderBy("date").collect()
        return [(r["date"], r["value"]) for r in rows]

    ingest(spark, store, f"{tmp_path}/one", "eurostat_hicp", "2024-06-01")
    ingest(spark, store, f"{tmp_path}/two", "eurostat_hicp", "2024-07-01")
    # Seven days before 2024-03-01 lie in February, which is taken from its first day on.
    months = [day(f"2024-0{m}-01") for m in (1, 2, 3, 4)]
    assert values() == list(zip(months, [1.0, 2.0, 2.0, 2.0]))
    ingest(spark, store, f"{tmp_path}/two", "eurostat_hicp", "2024-08-01", full_history=True)
    assert values() == list(zip(months, [2.0] * 4))


def test_bad_lines_are_kept_with_their_places(spark, tmp_path):
    """Lines of a file that is read in several blocks: good and bad ones together are all that landed."""
    good = {"ticker": "a", "timestamp": 1704067200000, "close": 2}
    lines = []
    for n in range(300):
        bad = {**good, "timestamp": "soon"} if n % 10 == 3 else {"ticker": "a"} if n % 10 == 5 else good
        lines.append(json.dumps({**bad, "transactions": n}) if n % 10 != 7 else '{"ticker": "a", "ti')
    put(tmp_path / "landing/daily_bars/b.json", "\n".join(lines) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "4096")
    try:
        for _ in range(2):  # started again, a run has its rejects once
            ingest(spark, f"{tmp_path}/s", f"{tmp_path}/landing", "daily_bars", BATCH, run_id="r")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    rows = read_rejects(spark, f"{tmp_path}/s", "r").collect()
    assert len(rows) == 90 and len({(r["file"], r["block"], r["line"]) for r in rows}) == 90
    assert len({r["block"] for r in rows}) > 2
    # The place finds the line again: blocks begin at the first line that starts after their first byte.
    text = (tmp_path / "landing/daily_bars/b.json").read_text()
    for row in rows:
        start = 0 if row["block"] == 0 else text.index("\n", row["block"]) + 1
        assert text[start:].split("\n")[row["line"]] == row["raw"]
    counts = {r["item"]: (r["landed"], r["rejected"]) for r in read_outcomes(spark, f"{tmp_path}/s", "r").collect()}
    assert counts == {"A": (270, 60), "?": (30, 30)}


def test_series_with_bad_values_are_rejects(spark, tmp_path):
    put(tmp_path / "landing/gsw_term_premiums/spot/5Y.json", {"observations": [{"date": "2024-01-02", "value": "0.1"}]})
    put(tmp_path / "landing/gsw_term_premiums/forward/5Y.json", {"observations": [{"date": "2024-01-02", "value": "high"}]})
    ledger = ingest(spark, f"{tmp_path}/s", f"{tmp_path}/landing", "gsw_term_premiums", BATCH, run_id="r")
    assert [r["status"] for r in ledger.collect()] == ["saved"]
    rows = read_rejects(spark, f"{tmp_path}/s", "r").collect()
    assert [(r["item"], r["line"], r["reason"], r["file"].split("/")[-2]) for r in rows] == [("5Y", 0, "bad value", "forward")]
    assert read_rejects(spark, f"{tmp_path}/none").count() == 0
