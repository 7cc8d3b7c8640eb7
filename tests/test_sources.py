"""Landed payloads written to disk and read through the sources."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, ts
from tidemark import constants as K
from tidemark.catalog import DATASETS
from tidemark.operators.union import relaxed_union
from tidemark.sources import bars, files, fundamentals, options, rates, statistics
from tidemark.sources.landed import header_lines, read_landed, read_landed_table

BATCH = "2024-06-01 00:00:00"


def land(folder, payloads: dict[str, str]) -> str:
    folder.mkdir(exist_ok=True)
    for name, text in payloads.items():
        (folder / f"{name}.json").write_text(text)
    return str(folder)


def landed(spark, **payloads):
    rows = [(s, p if isinstance(p, str) else json.dumps(p)) for s, p in payloads.items()]
    return spark.createDataFrame(rows, "symbol STRING, raw STRING")


def observations(*pairs) -> str:
    return json.dumps({"observations": [{"date": d, "value": v, "realtime_start": "x"} for d, v in pairs]})


def test_observation_files(spark, tmp_path):
    folder = land(
        tmp_path / "fred",
        {
            "1M": observations(("2024-01-01", "4.5"), ("2024-01-02", ".")),
            "3M": observations(("2024-01-02", "4.6")),
            "6M": observations(),
            "1Y": '{"observations":[',
            "2Y": observations(("2024-01-01", "oops")),
            "3Y": observations(("yesterday", "1")),
        },
    )
    payloads = read_landed(spark, folder)
    rows = sorted(tuple(r) for r in rates.fred_observations(payloads).collect())
    assert rows == [("1M", day("2024-01-01"), 4.5), ("1M", day("2024-01-02"), None), ("3M", day("2024-01-02"), 4.6)]
    reasons = {r["symbol"]: r["reason"] for r in rates.fred_quarantine(payloads).collect()}
    assert reasons == {"1Y": "not JSON", "2Y": "bad value", "3Y": "bad date"}


def test_a_failed_series_adds_no_rows_to_the_batch(spark):
    payloads = landed(spark, **{"1M": observations(("2024-01-01", "4.5")), "3M": '{"observations":['})
    batch = rates.curve_batch(payloads, "constant_maturity", BATCH)
    assert [(r["tenor"], r["fred_series_id"]) for r in batch.collect()] == [("1M", "DGS1MO")]
    assert batch.dtypes == spark.createDataFrame([], DATASETS["treasury_constant_maturity"].schema).dtypes
    with pytest.raises(KeyError):
        rates.curve_batch(payloads, "constant_maturity", BATCH, ["4Y"])


def test_ecb_table(spark, tmp_path):
    (tmp_path / "ecb.csv").write_text(
        "KEY,FREQ,TIME_PERIOD,OBS_VALUE\n"
        "ICP.M.U2.Y.000000.3.INX,M,2024-01,123.4\n"
        "ICP.M.U2.Y.000000.3.INX,M,2024-02,n/a\n"
        "FM.D.U2.EUR.4F.KR.DFR.LEV,D,2024-01-15,4.0\n"
        "OTHER,D,2024-01-15,1.0\n"
    )
    table = read_landed_table(spark, str(tmp_path / "ecb.csv"))
    hicp = rates.ecb_group(table, "hicp", BATCH).orderBy("date").collect()
    assert [(r["date"], r["value"], r["series_label"]) for r in hicp] == [
        (day("2024-01-01"), 123.4, "hicp_all_items"),
        (day("2024-02-01"), None, "hicp_all_items"),
    ]
    rate = rates.ecb_group(table, "interest_rates", BATCH, "deposit_facility").collect()
    assert [(r["date"], r["value"]) for r in rate] == [(day("2024-01-15"), 4.0)]
    assert rates.ecb_group(table, "interest_rates", BATCH, start="2024-02-01").count() == 0
    with pytest.raises(KeyError):
        rates.ecb_group(table, "hicp", BATCH, ["m1"])
    assert rates.ecb_series(table.drop("OBS_VALUE"), BATCH, "KEY").count() == 0
    assert rates.ecb_series(table, BATCH, "KEY").first()["series_label"] == table.first()["KEY"]


def test_statistical_queries(spark):
    geo = f"`{K.GEO_COLUMN}`"
    schema = f"freq STRING, na_item STRING, unit STRING, s_adj STRING, {geo} STRING, `2024-Q1` STRING, `2024Q2` STRING"
    rows = [
        ("Q", "B1GQ", "CLV10_MNAC", "SCA", "DE", "100.5", "101"),
        ("Q", "B1GQ", "CLV10_MNAC", "SCA", "PL", "1", "1"),
        ("Q", "P3", "CLV10_MNAC", "SCA", "DE", "1", "1"),
    ]
    gdp = statistics.gdp(spark.createDataFrame(rows, schema), BATCH)
    assert sorted((r["country"], r["date"], r["value"]) for r in gdp.collect()) == [
        ("DE", day("2024-01-01"), 100.5),
        ("DE", day("2024-04-01"), 101.0),
    ]
    assert gdp.dtypes == spark.createDataFrame([], DATASETS["eurostat_gdp"].schema).dtypes


def test_statements(spark):
    payloads = landed(
        spark,
        ibm={
            "symbol": "IBM",
            "annualReports": [
                {"fiscalDateEnding": "2024-01-31", "reportedCurrency": "EUR", "grossProfit": "1", "ebitda": "None", "newField": "5"}
            ],
            "quarterlyReports": [{"fiscalDateEnding": "bad", "totalRevenue": "2.5"}],
        },
        nothing={},
        broken='{"annualReports":[',
        refused={"Note": "API call frequency"},
    )
    rows = fundamentals.fundamentals(payloads, "income_statement", BATCH).orderBy("report_type").collect()
    assert len(rows) == 2
    annual, quarterly = rows
    assert (annual["ticker"], annual["gross_profit"], annual["ebitda"]) == ("IBM", 1.0, None)
    assert annual["extra"] == {"new_field": "5"}
    assert annual["reported_currency"] == "EUR"
    assert (quarterly["fiscal_date_ending"], quarterly["reported_currency"]) == (None, "USD")
    assert quarterly["total_revenue"] == 2.5
    reasons = {r["symbol"]: r["reason"] for r in fundamentals.fundamentals_quarantine(payloads).collect()}
    assert reasons == {"broken": "not JSON", "refused": "API call frequency"}
    with pytest.raises(ValueError):
        fundamentals.fundamentals(payloads, "profit", BATCH)


def test_earnings_use_their_own_sections(spark):
    payloads = landed(
        spark,
        IBM={"quarterlyEarnings": [{"fiscalDateEnding": "2024-03-31", "reportedEPS": "1.5", "reportTime": "pre-market"}]},
    )
    row = fundamentals.fundamentals(payloads, "earnings", BATCH).first()
    assert (row["reported_eps"], row["report_time"], row["report_type"]) == (1.5, "pre-market", "quarterly")


def test_overview(spark):
    payloads = landed(
        spark,
        x={"Symbol": "X", "Name": "Ex", "MarketCapitalization": "2500000000000", "PERatio": "None"},
        empty={},
    )
    rows = fundamentals.overview(payloads, BATCH).collect()
    assert [(r["ticker"], r["name"], r["market_capitalization"]) for r in rows] == [("X", "Ex", 2500000000000)]
    assert rows[0]["extra"] == {}


def test_adjusted_series(spark):
    day_one = {"1. open": "1.0", "5. adjusted close": "1.1", "7. dividend amount": "0"}
    payloads = landed(
        spark,
        a={"Meta Data": {"2. Symbol": "A"}, "Time Series (Daily)": {"2024-01-02": day_one}},
        b={"Weekly Adjusted Time Series": {"2024-01-05": day_one}},
        c={"Time Series (Daily)": {"soon": day_one}},
        d={"Information": "higher API call frequency"},
        e={},
    )
    rows = fundamentals.adjusted_series(payloads, "daily_adjusted", BATCH).orderBy("ticker").collect()
    assert [(r["ticker"], r["date"], r["open"], r["adjusted_close"]) for r in rows] == [
        ("A", day("2024-01-02"), 1.0, 1.1),
        ("B", day("2024-01-05"), 1.0, 1.1),
    ]
    reasons = {r["symbol"]: r["reason"] for r in fundamentals.adjusted_quarantine(payloads).collect()}
    assert reasons == {"c": "bad date", "d": "higher API call frequency", "e": "no series"}


def test_bars_and_open_close(spark):
    bar = {"timestamp": 1704067200000, "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 10, "vwap": 1.2, "transactions": 3}
    payloads = landed(spark, aapl=bar)
    row = bars.daily_bars(payloads, BATCH).first()
    assert (row["ticker"], row["date"], row["low"], row["transactions"]) == ("AAPL", day("2024-01-01"), 0.5, 3)
    assert bars.daily_bars(payloads, BATCH, start="2024-01-02").count() == 0
    snapshot = bars.open_close(landed(spark, aapl={"open": 1.0, "afterHours": 2.0}), BATCH, "2024-01-03").first()
    assert (snapshot["date"], snapshot["after_hours"], snapshot["pre_market"]) == (day("2024-01-03"), 2.0, None)


def test_details_and_listing(spark):
    details = {"name": "Apple", "active": True, "market_cap": 3e12, "address": {"city": "Cupertino"}, "branding": None}
    row = bars.ticker_details(landed(spark, aapl=details), BATCH).first()
    assert (row["ticker"], row["market_cap"]) == ("AAPL", 3e12)
    assert json.loads(row["address"]) == {"city": "Cupertino"}
    assert row["branding"] is None
    entries = {f"e{i}": {"ticker": f"T{i:04d}", "market": "stocks"} for i in range(700)}
    listing = bars.ticker_list(landed(spark, **entries), BATCH, limit=300)
    assert listing.count() == 500
    assert listing.agg(F.max("ticker")).first()[0] == "T0499"


def contract(symbol, **fields) -> str:
    return json.dumps({"contractSymbol": symbol, "strike": 260.0, "lastPrice": 32.36, "bid": 29.9, "volume": 7.0, "inTheMoney": True, "currency": "USD", **fields})


def chain_rows(spark, *rows):
    return spark.createDataFrame(
        [("aapl", e, q, p, ts("2026-06-13T12:00:00"), raw) for e, q, p, raw in rows],
        "underlying STRING, expiry STRING, quick_price DOUBLE, profile_price DOUBLE, snapshot_ts TIMESTAMP, raw STRING",
    )


def test_option_chain(spark):
    calls = options.parse_chain(
        chain_rows(
            spark,
            ("2026-06-15", 220.5, 1.0, contract("C1")),
            ("2026-06-15", 220.5, 1.0, contract("C1")),
            ("2026-07-15", None, 10.25, contract("C2", volume=None)),
        )
    )
    puts = options.parse_chain(chain_rows(spark, ("2026-06-15", 220.5, None, contract("P1"))))
    chain = options.option_chain(calls, puts)
    assert chain.schema.fieldNames() == DATASETS["options"].schema.fieldNames()
    rows = {r["contract_symbol"]: r for r in chain.collect()}
    assert set(rows) == {"C1", "C2", "P1"}
    assert rows["C1"]["underlying_price"] == Decimal("220.500000")
    assert rows["C2"]["underlying_price"] == Decimal("10.250000")
    assert (rows["C1"]["volume"], rows["C2"]["volume"], rows["P1"]["type"]) == (7, None, "put")
    assert (rows["C1"]["underlying"], rows["C1"]["snapshot_date"]) == ("AAPL", day("2026-06-13"))
    assert options.option_chain(calls, puts, ["2026-07-15", "2030-01-01"]).count() == 1
    wanted = spark.createDataFrame([("aapl", day("2026-06-15")), ("aapl", day("2030-01-01"))], "underlying STRING, expiry DATE")
    assert [r["expiry"] for r in options.missing_expiries(wanted, calls, puts).collect()] == [day("2030-01-01")]


def test_one_sided_chain(spark):
    calls = options.parse_chain(chain_rows(spark, ("2026-06-15", 1.0, None, contract("C1"))))
    assert options.option_chain(calls, calls.limit(0)).count() == 1


def test_csv_to_parquet(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("SIC;NAICS\n0111;111140\n")
    target = str(tmp_path / "codes")
    files.csv_to_parquet(spark, str(tmp_path / "codes.csv"), target, "csv", ";", "SIC STRING, NAICS INT")
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [("0111", 111140)]
    with pytest.raises(ValueError):
        files.csv_to_parquet(spark, str(tmp_path / "codes.csv"), target, "xlsx")


def test_absent_table_is_empty_and_unreadable_one_is_an_error(spark, tmp_path):
    schema = DATASETS["daily_bars"].schema
    assert files.read_table(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "bad.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        files.read_table(spark, str(tmp_path / "bad.parquet"), schema).collect()


def test_listing_shows_unreadable_files_without_counts(spark, tmp_path):
    spark.range(5).withColumn("x", F.lit(1)).coalesce(1).write.parquet(str(tmp_path / "d" / "good.parquet"))
    (tmp_path / "d" / "bad.parquet").write_text("not parquet")
    rows = files.list_files(spark, str(tmp_path / "d")).collect()
    assert sorted((r["rows"] is None, r["rows"], r["columns"]) for r in rows) == [(False, 5, 2), (True, None, None)]
    assert all(r["bytes"] > 0 and not r["relative_path"].startswith("/") for r in rows)
    assert all((r["reason"] is None) == (r["rows"] is not None) for r in rows)


def test_read_all_unites_types(spark, tmp_path):
    spark.createDataFrame([(1,)], "v INT").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([("x", 2)], "v STRING, w INT").write.parquet(str(tmp_path / "b"))
    both = files.read_all(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted((r["v"], r["w"]) for r in both.collect()) == [("1", None), ("x", 2)]
    assert relaxed_union(both).columns == ["v", "w"]


def test_headers_of_files_of_several_splits(spark, tmp_path):
    folder = tmp_path / "tables"
    folder.mkdir()
    (folder / "a.csv").write_text("\nKEY,OBS_VALUE\n" + "".join(f"a{n},{n}\n" for n in range(5_000)))
    (folder / "b.csv").write_text("OBS_VALUE,KEY\r\n" + "".join(f"{n},b{n}\r\n" for n in range(5_000)))
    (folder / "empty.csv").write_text("")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
        heads = {r["file"][-5:]: r["header"] for r in header_lines(spark, str(folder)).collect()}
        rows = read_landed_table(spark, str(folder)).select("KEY", "OBS_VALUE").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert heads == {"a.csv": "KEY,OBS_VALUE", "b.csv": "OBS_VALUE,KEY"}
    assert sorted(map(tuple, rows)) == sorted((f"{x}{n}", str(n)) for x in "ab" for n in range(5_000))


def test_files_with_other_headers_are_read_by_name(spark, tmp_path):
    folder = tmp_path / "tables"
    folder.mkdir()
    (folder / "a.csv").write_text("KEY,TIME_PERIOD,OBS_VALUE\nx,2024-01,1\n")
    (folder / "b.csv").write_text("OBS_VALUE,KEY,TIME_PERIOD\r\n2,y,2024-02\r\n")
    (folder / "c.csv").write_text("KEY,TIME_PERIOD,OBS_VALUE\nz,2024-03,3\n")
    rows = read_landed_table(spark, str(folder)).select("KEY", "TIME_PERIOD", "OBS_VALUE").collect()
    assert sorted(map(tuple, rows)) == [("x", "2024-01", "1"), ("y", "2024-02", "2"), ("z", "2024-03", "3")]
    typed = read_landed_table(spark, str(folder), "OBS_VALUE INT, KEY STRING, NOTE STRING").collect()
    assert sorted(map(tuple, typed)) == [(1, "x", None), (2, "y", None), (3, "z", None)]


def test_payloads_over_many_lines_are_one(spark, tmp_path):
    (tmp_path / "AAA.json").write_text('{"name": "a",\n "note": {"x": 1},\n "sic": "7"}\n')
    landed_files = read_landed(spark, str(tmp_path))
    row = bars.ticker_details(landed_files, BATCH).first()
    assert (row["ticker"], row["name"], dict(row["extra"])) == ("AAA", "a", {"note": '{"x":1}', "sic": "7"})


def test_listing_keeps_all_markets_and_fields(spark):
    entries = {f"k{n}": {"ticker": f"T{n}", "market": "stocks" if n % 2 else "otc", "cik": n} for n in range(30)}
    rows = bars.ticker_list(landed(spark, **entries), BATCH).collect()
    assert len(rows) == 30 and {r["extra"]["cik"] for r in rows} == {str(n) for n in range(30)}


def test_text_in_a_number_column_is_kept(spark):
    report = {"fiscalDateEnding": "2024-01-31", "grossProfit": "n.m.", "totalRevenue": "5"}
    row = fundamentals.fundamentals(landed(spark, A={"annualReports": [report]}), "income_statement", BATCH).first()
    assert row["gross_profit"] is None and row["total_revenue"] == 5 and row["extra"]["gross_profit"] == "n.m."


def test_one_bad_contract_does_not_stop_its_chain(spark):
    rows = [("A", "2024-05-01", '{"contractSymbol":"C1"}'), ("B", "soon", '{"contractSymbol":"C2"}'), ("C", "2024-05-01", "{")]
    frame = spark.createDataFrame(rows, "underlying STRING, expiry STRING, raw STRING").selectExpr(
        "*", "1.0D AS quick_price", "2.0D AS profile_price", "timestamp'2024-01-01' AS snapshot_ts"
    )
    assert [r["contractSymbol"] for r in options.parse_chain(frame).collect()] == ["C1"]
    reasons = frame.select(options.contract_problem().alias("r")).collect()
    assert [r["r"] for r in reasons] == [None, "bad expiry", "not JSON"]
