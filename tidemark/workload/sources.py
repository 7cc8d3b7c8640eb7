"""Landed payloads, built row by row from the driver tables, through the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.session import scratch_root
from tidemark.sources import bars, files, fundamentals, options, rates, statistics
from tidemark.sources.landed import is_broken_json, quarantine
from tidemark.workload.registry import BATCH_TS, TABLES, cents, query, shown, table
from tidemark.workload.reshaping import _TENOR_SQL, tenor_column


def _day(column: str):
    return F.date_format(column, "yyyy-MM-dd")


def _observation_payloads(spark, sf):
    """One payload per order: its price and a missing value; pending orders are corrupt."""
    items = F.array(
        F.struct(_day("o_orderdate").alias("date"), cents("o_totalprice").cast("bigint").cast("string").alias("value")),
        F.struct(_day(F.date_add("o_orderdate", 1)).alias("date"), F.lit(".").alias("value")),
    )
    payload = F.to_json(F.struct(items.alias("observations")))
    raw = (
        F.when(F.col("o_orderstatus") == "P", F.lit('{"observations":['))
        .when(F.col("o_custkey") < 20, F.replace(payload, F.lit('"."'), F.lit('"bad"')))
        .otherwise(payload)
    )
    return table(spark, sf, "orders").select(tenor_column().alias("symbol"), raw.alias("raw"))


_SOUND = "o_orderstatus <> 'P' AND o_custkey >= 20"


@query("fred_observations", f"""
    SELECT {_TENOR_SQL} AS tenor, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
           round(o_totalprice * 100) AS value FROM orders WHERE {_SOUND}
    UNION ALL
    SELECT {_TENOR_SQL}, CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR), NULL
    FROM orders WHERE {_SOUND}""")
def _fred_observations(spark, sf):
    return shown(rates.fred_observations(_observation_payloads(spark, sf)))


@query("fred_quarantine", f"""
    SELECT {_TENOR_SQL} AS symbol,
           CASE WHEN o_orderstatus = 'P' THEN 'not JSON' ELSE 'bad value' END AS reason, count(*) AS n
    FROM orders WHERE NOT ({_SOUND}) GROUP BY ALL""")
def _fred_quarantine(spark, sf):
    rejected = rates.fred_quarantine(_observation_payloads(spark, sf))
    return rejected.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("curve_batch", f"""
    SELECT 'DGS' || substr(tenor, 1, 1) AS fred_series_id, tenor, 'constant_maturity' AS component,
           'FRED' AS source, count(*) AS n, count(value) AS filled, sum(value) AS total
    FROM (SELECT {_TENOR_SQL} AS tenor, round(o_totalprice * 100) AS value FROM orders WHERE {_SOUND}
          UNION ALL SELECT {_TENOR_SQL}, NULL FROM orders WHERE {_SOUND})
    WHERE tenor IN ('1Y', '3Y', '7Y') GROUP BY ALL""")
def _curve_batch(spark, sf):
    rows = rates.curve_batch(
        _observation_payloads(spark, sf), "constant_maturity", BATCH_TS, ["1Y", "3Y", "7Y"]
    )
    return rows.groupBy("fred_series_id", "tenor", "component", "source").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("filled"), F.sum("value").alias("total")
    )


_HICP = K.ECB_GROUPS["hicp"]
_OTHER = list(K.ECB_GROUPS["interest_rates"].values())
_KEYS = [*_HICP.values(), *_OTHER]


@query("ecb_series", """
    SELECT CAST(CAST(CASE l_linestatus WHEN 'O' THEN date_trunc('month', l_shipdate)
                     ELSE l_shipdate END AS DATE) AS VARCHAR) AS date,
           %s AS series_label, %s AS series_id, 'ECB' AS source,
           count(*) AS n, CAST(sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) AS DOUBLE) AS total
    FROM lineitem WHERE l_linenumber <= 4 GROUP BY ALL""" % tuple(
    "CASE l_linenumber " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values, 1)) + " END"
    for values in (list(_HICP), list(_HICP.values()))
))
def _ecb_series(spark, sf):
    # Daily and monthly periods are mixed; a third of the values is no number.
    lines = table(spark, sf, "lineitem").select(
        F.element_at(F.array(*[F.lit(k) for k in _KEYS]), F.col("l_linenumber")).alias("KEY"),
        F.when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "yyyy-MM"))
        .otherwise(_day("l_shipdate"))
        .alias("TIME_PERIOD"),
        F.when(F.col("l_returnflag") == "N", F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("OBS_VALUE"),
    )
    rows = rates.ecb_group(lines, "hicp", BATCH_TS)
    return shown(
        rows.groupBy("date", "series_label", "series_id", "source").agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
        )
    )


_GEOS = ["EA", "DE", "FR", "IT", "ES", "NL", "BE"]
_GEO_SQL = "CASE l_linenumber " + " ".join(
    f"WHEN {i} THEN '{g}'" for i, g in enumerate(_GEOS, 1)
) + " END"
_STAT_PERIODS = """
    SELECT *, '2024-01-01' AS date, l_quantity AS v FROM lineitem
    UNION ALL SELECT *, '2024-04-01', l_quantity + 1 FROM lineitem WHERE l_tax <> 0"""


def _statistical_table(spark, sf):
    """Line items as a statistical table with dimension and period columns."""
    geo = F.element_at(F.array(*[F.lit(g) for g in _GEOS]), F.col("l_linenumber"))
    flag, status, q = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    curve = F.when(flag == "A", "PAR").when(flag == "N", "SPOT_RT").otherwise("INS_FWD")
    return table(spark, sf, "lineitem").select(
        F.lit("M").alias("freq"),
        geo.alias(K.GEO_COLUMN),
        curve.alias("yld_curv"),
        F.when(status == "O", "CGB_EA").otherwise("CGB_EA_AAA").alias("bonds"),
        F.concat(F.lit("Y"), cents("l_discount").cast("int")).alias("maturity"),
        F.when(status == "O", "GBY_LT").otherwise("OTHER").alias("int_rt"),
        F.when(flag == "A", "CP00").otherwise("CP01").alias("coicop"),
        F.when(flag == "R", "B1GQ").otherwise("P3").alias("na_item"),
        F.when(status == "F", "CLV10_MNAC").otherwise("CP_MEUR").alias("unit"),
        F.when(F.col("l_tax") > 0.03, "SCA").otherwise("NSA").alias("s_adj"),
        q.cast("string").alias("2024-01"),
        F.when(F.col("l_tax") != 0, (q + 1).cast("string")).otherwise(F.lit(":")).alias("2024-Q2"),
    )


def _totals(rows, *keys):
    return shown(
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    )


@query("euro_area_yield_curve", f"""
    SELECT date, 'Y' || CAST(round(l_discount * 100) AS INTEGER) AS maturity, 'SPOT_RT' AS curve_type,
           'CGB_EA' AS bond_type, 'euro_area_yield_curve_spot_rt' AS indicator,
           count(*) AS n, CAST(sum(v) AS DOUBLE) AS total
    FROM ({_STAT_PERIODS})
    WHERE l_linenumber = 1 AND l_returnflag = 'N' AND l_linestatus = 'O'
      AND CAST(round(l_discount * 100) AS INTEGER) IN (1, 2, 3, 5, 10, 20, 30) GROUP BY ALL""")
def _euro_area_yield_curve(spark, sf):
    rows = statistics.euro_area_yield_curve(_statistical_table(spark, sf), BATCH_TS, "SPOT_RT")
    return _totals(rows, "date", "maturity", "curve_type", "bond_type", "indicator")


@query("gov_bond_yields", f"""
    SELECT date, {_GEO_SQL} AS country, 'Y10' AS maturity, 'gov_bond_yield_10y' AS indicator,
           count(*) AS n, CAST(sum(v) AS DOUBLE) AS total
    FROM ({_STAT_PERIODS}) WHERE l_linestatus = 'O' AND l_linenumber > 1 GROUP BY ALL""")
def _gov_bond_yields(spark, sf):
    rows = statistics.gov_bond_yields(_statistical_table(spark, sf), BATCH_TS)
    return _totals(rows, "date", "country", "maturity", "indicator")


@query("eurostat_hicp", f"""
    SELECT date, {_GEO_SQL} AS country, 'all_items' AS item,
           CASE l_linestatus WHEN 'F' THEN 'CLV10_MNAC' ELSE 'CP_MEUR' END AS unit,
           count(*) AS n, CAST(sum(v) AS DOUBLE) AS total
    FROM ({_STAT_PERIODS}) WHERE l_returnflag = 'A' AND l_linenumber <= 6 GROUP BY ALL""")
def _eurostat_hicp(spark, sf):
    rows = statistics.hicp(_statistical_table(spark, sf), BATCH_TS)
    return _totals(rows, "date", "country", "item", "unit")


@query("eurostat_gdp", f"""
    SELECT date, {_GEO_SQL} AS country, 'gdp_volume_sa' AS indicator,
           count(*) AS n, CAST(sum(v) AS DOUBLE) AS total
    FROM ({_STAT_PERIODS})
    WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_tax > 0.03 AND l_linenumber <= 3
    GROUP BY ALL""")
def _eurostat_gdp(spark, sf):
    rows = statistics.gdp(_statistical_table(spark, sf), BATCH_TS, ["EA", "DE", "FR"])
    return _totals(rows, "date", "country", "indicator")


def _statement_payloads(spark, sf):
    """One payload per order: an annual report, and a quarterly one unless it is open."""
    money = cents("o_totalprice").cast("bigint").cast("string")
    date = _day("o_orderdate")
    annual = F.create_map(
        F.lit("fiscalDateEnding"), date,
        F.lit("reportedCurrency"), F.lit("EUR"),
        F.lit("grossProfit"), money,
        F.lit("netIncome"), F.lit("None"),
        F.lit("costOfRevenue"), F.lit("1"),
    )
    quarterly = F.create_map(
        F.lit("fiscalDateEnding"), F.when(F.col("o_custkey") < 20, "n/a").otherwise(date),
        F.lit("totalRevenue"), money,
    )
    none = F.array().cast("array<map<string,string>>")
    quarters = F.when(F.col("o_orderstatus") == "O", none).otherwise(F.array(quarterly))
    sections = F.struct(F.array(annual).alias("annualReports"), quarters.alias("quarterlyReports"))
    return table(spark, sf, "orders").select(
        F.lower("o_orderpriority").alias("symbol"), F.to_json(sections).alias("raw")
    )


@query("fundamentals", """
    SELECT o_orderpriority AS ticker, 'annual' AS report_type,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fiscal_date_ending, 'EUR' AS reported_currency,
           round(o_totalprice * 100) AS gross_profit, CAST(NULL AS DOUBLE) AS total_revenue,
           CAST(NULL AS DOUBLE) AS net_income, '1' AS cost_of_revenue, 'ALPHA_VANTAGE' AS source
    FROM orders
    UNION ALL
    SELECT o_orderpriority, 'quarterly',
           CASE WHEN o_custkey >= 20 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END, 'USD',
           NULL, round(o_totalprice * 100), NULL, NULL, 'ALPHA_VANTAGE'
    FROM orders WHERE o_orderstatus <> 'O'""")
def _fundamentals(spark, sf):
    rows = fundamentals.fundamentals(_statement_payloads(spark, sf), "income_statement", BATCH_TS)
    return shown(
        rows.select(
            "ticker", "report_type", "fiscal_date_ending", "reported_currency", "gross_profit",
            "total_revenue", "net_income",
            F.col("extra")["cost_of_revenue"].alias("cost_of_revenue"), "source",
        )
    )


@query("overview", """
    SELECT upper(c_name) AS ticker, c_mktsegment AS sector,
           CAST(round(c_acctbal * 100) AS BIGINT) AS market_capitalization,
           CAST(c_nationkey AS VARCHAR) AS pe_ratio
    FROM customer WHERE c_acctbal >= 0""")
def _overview(spark, sf):
    # Profiles without "Symbol" give no row.
    profile = F.to_json(
        F.struct(
            F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("Symbol"),
            F.col("c_mktsegment").alias("Sector"),
            cents("c_acctbal").cast("bigint").alias("MarketCapitalization"),
            F.col("c_nationkey").alias("PERatio"),
            F.lit("None").alias("Industry"),
        )
    )
    landed = table(spark, sf, "customer").select(F.col("c_name").alias("symbol"), profile.alias("raw"))
    rows = fundamentals.overview(landed, BATCH_TS)
    return rows.select(
        "ticker", "sector", "market_capitalization", F.col("extra")["peratio"].alias("pe_ratio")
    )


@query("adjusted_series", """
    SELECT o_orderpriority AS ticker, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
           'daily_adjusted' AS interval, round(o_totalprice * 100) AS open,
           round(o_totalprice * 100) + 1 AS adjusted_close, CAST(o_custkey AS DOUBLE) AS volume
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderpriority, CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR), 'daily_adjusted',
           NULL, 0, NULL
    FROM orders WHERE o_orderstatus <> 'P'""")
def _adjusted_series(spark, sf):
    # Pending orders have an undated row and are left out as a whole.
    price = cents("o_totalprice").cast("bigint")
    first = F.create_map(
        F.lit("1. open"), price.cast("string"),
        F.lit("5. adjusted close"), (price + 1).cast("string"),
        F.lit("6. volume"), F.col("o_custkey").cast("string"),
    )
    second = F.create_map(F.lit("1. open"), F.lit("None"), F.lit("5. adjusted close"), F.lit("0"))
    next_day = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(
        _day(F.date_add("o_orderdate", 1))
    )
    series = F.create_map(_day("o_orderdate"), first, next_day, second)
    payload = F.struct(
        F.create_map(F.lit("2. Symbol"), F.col("o_orderpriority")).alias("Meta Data"),
        series.alias("Daily Time Series"),
    )
    landed = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("symbol"), F.to_json(payload).alias("raw")
    )
    rows = fundamentals.adjusted_series(landed, "daily_adjusted", BATCH_TS)
    return shown(rows.select("ticker", "date", "interval", "open", "adjusted_close", "volume"))


def _bar_payloads(spark, sf):
    from tidemark.functions import as_utc

    millis = F.floor(F.unix_micros(as_utc("ts")) / 1000)
    price = cents("value")
    bar = F.struct(
        millis.alias("timestamp"), price.alias("open"), price.alias("close"),
        F.col("user_id").alias("volume"), F.col("event_id").alias("transactions"),
    )
    return table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), F.to_json(bar).alias("raw"), "ts"
    )


@query("daily_bars", """
    SELECT upper(event_type) AS ticker, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
           round(value * 100) AS open, CAST(NULL AS DOUBLE) AS high, round(value * 100) AS close,
           CAST(user_id AS DOUBLE) AS volume, event_id AS transactions, 'POLYGON' AS source
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""")
def _daily_bars(spark, sf):
    rows = bars.daily_bars(_bar_payloads(spark, sf), BATCH_TS, "2024-01-05", "2024-01-25")
    return shown(rows.select("ticker", "date", "open", "high", "close", "volume", "transactions", "source"))


@query("open_close", """
    SELECT upper(event_type) AS ticker, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
           round(value * 100) AS open, CAST(user_id AS DOUBLE) AS after_hours,
           CAST(NULL AS DOUBLE) AS pre_market
    FROM events""")
def _open_close(spark, sf):
    snapshot = F.struct(cents("value").alias("open"), F.col("user_id").alias("afterHours"))
    landed = table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), _day("ts").alias("date"), F.to_json(snapshot).alias("raw")
    )
    rows = bars.open_close(landed, BATCH_TS)
    return shown(rows.select("ticker", "date", "open", "after_hours", "pre_market"))


@query("ticker_details", """
    SELECT upper(s_name) AS ticker, s_name AS name, s_acctbal > 0 AS active,
           round(s_acctbal * 100) AS market_cap,
           '{"city":"' || s_nationkey || '","state":"x"}' AS address, CAST(NULL AS VARCHAR) AS branding,
           'S' || s_suppkey AS sic_code
    FROM supplier""")
def _ticker_details(spark, sf):
    address = F.struct(F.col("s_nationkey").cast("string").alias("city"), F.lit("x").alias("state"))
    details = F.struct(
        F.col("s_name").alias("name"), (F.col("s_acctbal") > 0).alias("active"),
        cents("s_acctbal").alias("market_cap"), address.alias("address"),
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("sic_code"),
    )
    landed = table(spark, sf, "supplier").select(F.col("s_name").alias("symbol"), F.to_json(details).alias("raw"))
    rows = bars.ticker_details(landed, BATCH_TS)
    # Fields that are not declared come along.
    return rows.select(
        "ticker", "name", "active", "market_cap", "address", "branding", F.col("extra")["sic_code"].alias("sic_code")
    )


@query("ticker_list", """
    SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS ticker, p_type AS market, p_name AS name
    FROM part WHERE p_type = 'ECONOMY' ORDER BY 1 LIMIT 500""")
def _ticker_list(spark, sf):
    # A limit of 120 is one whole page of the listing.
    entry = F.struct(
        F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("ticker"),
        F.col("p_name").alias("name"), F.col("p_type").alias("market"),
    )
    landed = table(spark, sf, "part").select(F.lit("listing").alias("symbol"), F.to_json(entry).alias("raw"))
    rows = bars.ticker_list(landed, BATCH_TS, market="ECONOMY", limit=120)
    return rows.select("ticker", "market", "name")


@query("option_chain", """
    SELECT upper('sup' || l_suppkey) AS underlying,
           CASE l_linestatus WHEN 'O' THEN 'call' ELSE 'put' END AS type,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS expiry,
           'C' || l_partkey AS contract_symbol,
           CAST(CASE WHEN l_suppkey < 50 THEN 220.5 ELSE 10.25 END AS DOUBLE) AS underlying_price
    FROM lineitem WHERE CAST(l_shipdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders
                                       WHERE o_orderpriority = '1-URGENT')
    GROUP BY ALL""")
def _option_chain(spark, sf):
    # Contracts that repeat in a snapshot are one row; the expiries asked for are a table.
    contract = F.struct(
        F.concat(F.lit("C"), F.col("l_partkey")).alias("contractSymbol"),
        F.lit(100.0).alias("strike"),
        F.lit("USD").alias("currency"),
    )
    landed = table(spark, sf, "lineitem").select(
        F.concat(F.lit("sup"), F.col("l_suppkey")).alias("underlying"),
        _day("l_shipdate").alias("expiry"),
        F.when(F.col("l_suppkey") < 50, F.lit(220.5)).alias("quick_price"),
        F.lit(10.25).alias("profile_price"),
        F.lit(BATCH_TS).cast("timestamp").alias("snapshot_ts"),
        F.to_json(contract).alias("raw"),
        F.when(F.col("l_linestatus") == "O", "call").otherwise("put").alias("type"),
    )
    expiries = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderdate").cast("date").alias("expiry")
    )
    chain = options.typed_option_chain(options.parse_chain(landed, expiries))
    return shown(chain.select("underlying", "type", "expiry", "contract_symbol", "underlying_price"))


@query("json_props", """
    SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total
    FROM events WHERE event_type <> 'error' GROUP BY 1""")
def _json_props(spark, sf):
    from tidemark.functions import null_token_number

    raw = F.when(F.col("event_type") == "error", F.lit('{"k":')).otherwise(F.col("props"))
    rows = table(spark, sf, "events").select("event_type", F.from_json(raw, "k STRING").alias("p"), raw.alias("raw"))
    sound = rows.where(~is_broken_json(F.col("raw")))
    return sound.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(null_token_number("p.k")).cast("bigint").alias("total")
    )


@query("batch_quarantine", """
    SELECT CAST(user_id AS VARCHAR) AS symbol,
           CASE event_type WHEN 'error' THEN 'not JSON' ELSE 'limit reached' END AS reason, count(*) AS n
    FROM events WHERE event_type IN ('error', 'view') GROUP BY ALL""")
def _batch_quarantine(spark, sf):
    # One scan over all symbols: broken and refused payloads are set aside, the rest goes on.
    raw = (
        F.when(F.col("event_type") == "error", F.lit('{"annualReports":['))
        .when(F.col("event_type") == "view", F.lit('{"Note":"limit reached"}'))
        .otherwise(F.col("props"))
    )
    landed = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("symbol"), raw.alias("raw"))
    rejected = fundamentals.fundamentals_quarantine(landed)
    return rejected.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("n"))


_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS relative_path, (SELECT count(*) FROM {t}) AS rows, "
    f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS columns"
    for t in TABLES
)


@query("list_files", _COUNTS_SQL)
def _list_files(spark, sf):
    return files.list_files(spark, sf).select("relative_path", "rows", "columns")


@query("file_info", """
    SELECT count(*) AS rows, CAST(11 AS INTEGER) AS columns, CAST(1 AS BIGINT) AS files FROM lineitem""")
def _file_info(spark, sf):
    return files.file_info(spark, f"{sf}/lineitem.parquet").select("rows", "columns", "files")


@query("csv_to_parquet", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _csv_to_parquet(spark, sf):
    root = scratch_root(spark, "csv")
    schema = "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING"
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    customers.write.option("header", "true").option("sep", "|").csv(f"{root}/text")
    files.csv_to_parquet(spark, f"{root}/text", f"{root}/table", "txt", "|", schema)
    return files.read_table(spark, f"{root}/table", customers.schema)


@query("read_all", """
    SELECT kind, count(*) AS n, sum(balance) AS total, count(segment) AS segments FROM (
      SELECT 'customer' AS kind, round(c_acctbal * 100) AS balance, c_mktsegment AS segment FROM customer
      UNION ALL SELECT 'supplier', round(s_acctbal * 100), NULL FROM supplier) GROUP BY 1""")
def _read_all(spark, sf):
    # Folders whose types and columns differ: bigint meets double, one column is missing.
    root = scratch_root(spark, "groups")
    table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), cents("c_acctbal").cast("bigint").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    ).write.parquet(f"{root}/customer")
    table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), cents("s_acctbal").alias("balance")
    ).write.parquet(f"{root}/supplier")
    both = files.read_all(spark, [f"{root}/customer", f"{root}/supplier"])
    return both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("balance").alias("total"), F.count("segment").alias("segments")
    )
