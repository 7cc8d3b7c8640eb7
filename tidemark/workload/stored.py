"""Saves, loads, stored rollups, upkeep and streams, in a scratch store.

Each query publishes whole driver tables into a fresh folder of the shared
scratch root and returns what a reader of the store sees.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.catalog import NOT_EMPTY, TABLES, Dataset, Gate, table_schema
from tidemark.functions import as_utc
from tidemark.operators.ledger import append_state, read_state
from tidemark.plans import load, rollup, save, upkeep
from tidemark.plans.outcomes import read_outcomes
from tidemark.session import scratch_root
from tidemark.sinks.published import PublishedTable, read_lineage
from tidemark.streaming import bucket_stream, landed_stream, merge_stream, refresh_touched
from tidemark.workload.registry import BARS_SQL, BATCH_TS, cents, query, shown, table

ORDER_PRICES = Dataset(
    "order_prices",
    table_schema("date DATE", "k BIGINT", "price DOUBLE", "last_fetched_at TIMESTAMP"),
    keys=("date", "k"),
    bucket_width="year",
    cluster_by=("k",),
)


def _price_batch(spark, sf, bump: int, days: int):
    """All orders as a batch, fetched ``days`` after the order was placed."""
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderkey").alias("k"),
        (cents("o_totalprice") + bump).alias("price"),
        (as_utc("o_orderdate") + F.make_dt_interval(F.lit(days))).alias("last_fetched_at"),
    )


@query("save_dataset", """
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, o_orderkey AS k,
           round(o_totalprice * 100) + CASE WHEN CAST(o_orderdate AS DATE) >=
             (SELECT CAST(max(o_orderdate) AS DATE) - 400 FROM orders) THEN 5 ELSE 0 END AS price
    FROM orders""")
def _save_dataset(spark, sf):
    # First load, an older batch that must lose, a newer one cut by the
    # lookback, and a repeat that must change nothing.
    store = scratch_root(spark, "save")
    for bump, days, lookback in ((0, 0, None), (9, -1, None), (5, 1, 400), (5, 1, 400)):
        save.save_dataset(spark, store, ORDER_PRICES, _price_batch(spark, sf, bump, days), lookback)
    return shown(PublishedTable(spark, store, ORDER_PRICES).read().drop("last_fetched_at"))


@query("lineage", """
    WITH n AS (SELECT count(*) AS n, count(DISTINCT k) AS k FROM
               (SELECT o_orderkey AS k FROM orders))
    SELECT 'order_prices' AS dataset, CAST(v AS BIGINT) AS version, n AS row_count,
           CAST(4 AS INTEGER) AS column_count, 'date:date,k:bigint,price:double,last_fetched_at:timestamp' AS columns,
           'orders' AS origin
    FROM n, (VALUES (1), (2)) AS t(v)""")
def _lineage(spark, sf):
    store = scratch_root(spark, "lineage")
    for days in (0, 1):
        batch = _price_batch(spark, sf, days, days)
        save.save_dataset(spark, store, ORDER_PRICES, batch, extra={"origin": "orders"})
    rows = read_lineage(spark, store)
    described = F.concat_ws(
        ",", F.transform("columns", lambda c: F.concat_ws(":", c["name"], c["dtype"]))
    )
    return rows.select(
        "dataset", "version", "row_count", "column_count",
        described.alias("columns"), F.col("extra")["origin"].alias("origin"),
    )


def _bar_batch(spark, sf, factor: int = 1, hollow: str | None = None):
    """Orders as daily bars, the later order of a day fetched later."""
    date = F.col("o_orderdate").cast("date")
    if hollow:
        date = F.when(F.col("o_orderpriority") != hollow, date)
    price = cents("o_totalprice") * factor
    fetched = F.timestamp_seconds(F.lit(factor) * 10_000_000_000 + F.col("o_orderkey"))
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("ticker"),
        date.alias("date"),
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.col("o_custkey").cast("double").alias("volume"),
        price.alias("vwap"),
        F.col("o_orderkey").alias("transactions"),
        F.lit("POLYGON").alias("source"),
        fetched.alias("last_fetched_at"),
    )


_DAILY_BARS = f"""
    daily AS (SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY seq DESC) AS rn
      FROM ({BARS_SQL})) WHERE rn = 1)"""


@query("save_by_item", f"""
    WITH {_DAILY_BARS}
    SELECT ticker, count(*) AS n, sum(price) AS total, CAST(sum(seq) AS BIGINT) AS seqs
    FROM daily WHERE ticker <> '3-MEDIUM' GROUP BY 1""")
def _save_by_item(spark, sf):
    # One ticker has no dates: it is left out, the others are published.
    store = scratch_root(spark, "items")
    save.save_by_item(spark, store, "daily_bars", _bar_batch(spark, sf, hollow="3-MEDIUM"))
    return save.read_dataset(spark, store, "daily_bars").groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("close").alias("total"),
        F.sum("transactions").alias("seqs"),
    )


@query("save_ledger", """
    SELECT DISTINCT 'run-1' AS run_id, 'daily_bars' AS dataset, o_orderpriority AS item,
           CASE o_orderpriority WHEN '3-MEDIUM' THEN 'failed' ELSE 'saved' END AS status,
           CASE o_orderpriority WHEN '3-MEDIUM' THEN 'not_all_null: all null: date' END AS reason
    FROM orders""")
def _save_ledger(spark, sf):
    store = scratch_root(spark, "ledger")
    batch = _bar_batch(spark, sf, hollow="3-MEDIUM")
    return save.save_by_item(spark, store, "daily_bars", batch, run_id="run-1")


@query("save_by_item_skipped", """
    WITH o AS (SELECT o_orderpriority AS item, CAST(o_orderdate AS DATE) AS date FROM orders),
    starts AS (SELECT item, max(date) - 7 AS start FROM o GROUP BY 1),
    b AS (SELECT o.*, date >= start AS late FROM o JOIN starts USING (item)
          WHERE item NOT LIKE '1%' OR date < start)
    SELECT item, CASE WHEN item LIKE '3%' THEN 'saved' ELSE 'skipped' END AS status,
           CASE WHEN item LIKE '1%' THEN 'before the start date' WHEN item NOT LIKE '3%' THEN 'nothing new' END AS reason,
           count(*) AS landed, count(*) FILTER (WHERE late) AS taken,
           CASE WHEN item LIKE '3%' THEN count(DISTINCT date) FILTER (WHERE late) ELSE 0 END AS kept,
           CASE WHEN item LIKE '3%' THEN count(DISTINCT date) FILTER (WHERE late) ELSE 0 END AS replaced
    FROM b GROUP BY item""")
def _save_by_item_skipped(spark, sf):
    # The second batch: old rows only of one ticker, later prices of one, the same rows of the others.
    store = scratch_root(spark, "skipped")
    save.save_by_item(spark, store, "daily_bars", _bar_batch(spark, sf))
    once, later = _bar_batch(spark, sf), _bar_batch(spark, sf, 2)
    ends = once.groupBy("ticker").agg(F.max("date").alias("end"))
    old = once.where("ticker LIKE '1%'").join(ends, "ticker").where("date < end - INTERVAL 7 DAYS").drop("end")
    same = once.where("ticker NOT LIKE '1%' AND ticker NOT LIKE '3%'")
    batch = old.unionByName(same).unionByName(later.where("ticker LIKE '3%'"))
    save.save_by_item(spark, store, "daily_bars", batch, lookback_days=7, run_id="run-2")
    return read_outcomes(spark, store, "run-2").select("item", "status", "reason", "landed", "taken", "kept", "replaced")


@query("save_by_country", """
    WITH daily AS (SELECT upper(event_type) AS country, CAST(ts AS DATE) AS date,
                          max(round(value * 100)) AS value FROM events GROUP BY 1, 2),
    starts AS (SELECT country, max(date) - 7 AS start FROM daily GROUP BY 1)
    SELECT daily.country, CAST(date AS VARCHAR) AS date,
           value + CASE WHEN date >= start THEN 1 ELSE 0 END AS value
    FROM daily JOIN starts ON starts.country = daily.country""")
def _save_by_country(spark, sf):
    # Every country has its own start date; older rows of the batch are not taken.
    store = scratch_root(spark, "countries")
    for bump, fetched in ((0, "2024-06-01"), (1, "2024-06-02")):
        batch = table(spark, sf, "events").groupBy(
            F.upper("event_type").alias("country"), F.col("ts").cast("date").alias("date")
        ).agg((F.max(cents("value")) + bump).alias("value"))
        batch = batch.withColumns(
            {"int_rt": F.lit("GBY_LT"), "last_fetched_at": F.lit(fetched).cast("timestamp")}
        )
        save.save_by_item(spark, store, "gov_bond_yields", batch, lookback_days=7 if bump else None)
    rows = save.read_dataset(spark, store, "gov_bond_yields")
    return shown(rows.select("country", "date", "value"))


@query("read_stored_key", """
    SELECT upper(event_type) AS country, count(*) AS n FROM
      (SELECT DISTINCT event_type, CAST(ts AS DATE) AS date FROM events WHERE event_type = 'view')
    GROUP BY 1""")
def _read_stored_key(spark, sf):
    store = scratch_root(spark, "key")
    batch = table(spark, sf, "events").select(
        F.upper("event_type").alias("country"),
        F.col("ts").cast("date").alias("date"),
        cents("value").alias("value"),
        F.lit("GBY_LT").alias("int_rt"),
        as_utc("ts").alias("last_fetched_at"),
    )
    save.save_by_item(spark, store, "gov_bond_yields", batch)
    rows = save.read_dataset(spark, store, "gov_bond_yields", key="view")
    return rows.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query("save_bundle", """
    SELECT 'run-1' AS run_id, 'gsw_term_premiums' AS dataset, 'saved' AS status,
           count(DISTINCT (CAST(o_orderdate AS DATE), o_custkey)) AS rows FROM orders
    UNION ALL SELECT 'run-1', 'eurostat_gdp', 'failed', 0
    UNION ALL SELECT 'run-1', 'daily_bars', 'saved', count(DISTINCT (o_orderpriority, CAST(o_orderdate AS DATE)))
    FROM orders""")
def _save_bundle(spark, sf):
    # The dataset in the middle lacks key columns; the others are saved.
    store = scratch_root(spark, "bundle")
    premiums = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.lit("1Y").alias("tenor"),
        cents("o_totalprice").alias("value"),
        F.concat(F.lit("S"), F.col("o_custkey")).alias("fred_series_id"),
        F.lit("term_premium_spot").alias("component"),
        F.timestamp_seconds(F.col("o_orderkey")).alias("last_fetched_at"),
    )
    batches = {
        "gsw_term_premiums": premiums,
        "eurostat_gdp": premiums.drop("tenor"),
        "daily_bars": _bar_batch(spark, sf),
    }
    ledger = save.save_bundle(spark, store, batches, "run-1").select("run_id", "dataset", "status")
    counts = [
        rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset", F.lit(name))
        for name, rows in save.read_datasets(spark, store, batches).items()
    ]
    stored = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return ledger.join(stored, "dataset").select("run_id", "dataset", "status", "rows")


@query("save_term_premiums", """
    WITH p AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS s, max(o_orderkey) AS k
               FROM (SELECT * REPLACE (CASE o_orderstatus WHEN 'F' THEN 'F' ELSE 'O' END AS o_orderstatus) FROM orders)
               GROUP BY 1, 2)
    SELECT CASE s WHEN 'F' THEN 'term_premium_spot' ELSE 'term_premium_forward' END AS component,
           CASE s WHEN 'F' THEN 'THREEFYTP1' ELSE 'THREEFFTP1' END AS fred_series_id,
           count(*) AS n, CAST(sum(k) AS DOUBLE) AS total
    FROM p GROUP BY ALL""")
def _save_term_premiums(spark, sf):
    store = scratch_root(spark, "premiums")

    def side(condition, component, series):
        return table(spark, sf, "orders").where(condition).select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.lit("1Y").alias("tenor"),
            F.col("o_orderkey").cast("double").alias("value"),
            F.lit(series).alias("fred_series_id"),
            F.lit(component).alias("component"),
            F.timestamp_seconds(F.col("o_orderkey")).alias("last_fetched_at"),
        )

    spot = side("o_orderstatus = 'F'", "term_premium_spot", "THREEFYTP1")
    forward = side("o_orderstatus <> 'F'", "term_premium_forward", "THREEFFTP1")
    save.save_term_premiums(spark, store, spot, forward)
    return save.read_dataset(spark, store, "gsw_term_premiums").groupBy(
        "component", "fred_series_id"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def _loaded_bars(spark, sf, store: str, factor: int = 1) -> str:
    save.save_dataset(spark, store, "daily_bars", _bar_batch(spark, sf, factor))
    target = f"{store}/tables"
    load.load_all(spark, store, target, ["market_data_daily"])
    return target


@query("load_all", f"""
    WITH {_DAILY_BARS}
    SELECT 'market_data_daily' AS "table", 'loaded' AS status, count(*) AS rows,
           CAST(11 AS INTEGER) AS columns FROM daily
    UNION ALL
    SELECT unnest(['fred_yield_curves', 'ecb_key_rates', 'ecb_hicp', 'ecb_monetary_aggregates',
                   'eurostat_yield_curve', 'eurostat_hicp', 'eurostat_gdp', 'fundamentals_income_stmt',
                   'fundamentals_overview', 'yfinance_options']), 'skipped', 0, 0""")
def _load_all(spark, sf):
    store = scratch_root(spark, "load")
    save.save_dataset(spark, store, "daily_bars", _bar_batch(spark, sf))
    return load.load_all(spark, store, f"{store}/tables").drop("reason")


@query("stored_counts", f"""
    WITH {_DAILY_BARS}
    SELECT 'market_data_daily' AS "table", count(*) AS rows FROM daily
    UNION ALL SELECT 'ecb_hicp', NULL""")
def _stored_counts(spark, sf):
    target = _loaded_bars(spark, sf, scratch_root(spark, "counts"))
    return load.table_counts(spark, target, ["market_data_daily", "ecb_hicp"])


@query("upsert_table", """
    SELECT upper('sup' || l_suppkey) AS underlying, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS expiry,
           'C' || l_partkey AS contract_symbol, CASE l_linestatus WHEN 'O' THEN 'call' ELSE 'put' END AS type,
           CASE l_linestatus WHEN 'O' THEN 2 ELSE 1 END AS bid, 'USD' AS currency
    FROM lineitem GROUP BY ALL""")
def _upsert_table(spark, sf):
    # Calls come again with a new bid and without a currency, which must stay.
    target = scratch_root(spark, "upsert")

    def chain(where: str, bid: int):
        return table(spark, sf, "lineitem").where(where).select(
            F.concat(F.lit("SUP"), F.col("l_suppkey")).alias("underlying"),
            F.when(F.col("l_linestatus") == "O", "call").otherwise("put").alias("type"),
            F.col("l_shipdate").cast("date").alias("expiry"),
            F.concat(F.lit("C"), F.col("l_partkey")).alias("contract_symbol"),
            F.lit(100).cast("decimal(18,6)").alias("strike"),
            F.lit("USD").alias("currency"),
            F.lit(bid).cast("decimal(18,6)").alias("bid"),
            F.lit(BATCH_TS).cast("timestamp").alias("snapshot_ts"),
            F.lit(BATCH_TS).cast("date").alias("snapshot_date"),
        )

    load.load_table(spark, target, "yfinance_options", chain("true", 1))
    load.load_table(spark, target, "yfinance_options", chain("l_linestatus = 'O'", 2).drop("currency"))
    rows = PublishedTable(spark, target, TABLES["yfinance_options"].dataset()).read()
    picked = rows.select("underlying", "expiry", "contract_symbol", "type", F.col("bid").cast("int").alias("bid"), "currency")
    return shown(picked)


_MONTHLY = """
    SELECT CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS bucket, ticker,
           first({p} ORDER BY date) AS open, max({p}) AS high, min({p}) AS low,
           last({p} ORDER BY date) AS close, sum(volume) AS total_volume, avg({p}) AS avg_vwap,
           count(*) AS trading_days
    FROM daily GROUP BY 1, 2"""


@query("refresh_rollup", f"""
    WITH {_DAILY_BARS},
    edge AS (SELECT max(date) AS d FROM daily),
    bounds AS (
      SELECT CASE WHEN date_trunc('month', d - INTERVAL 3 MONTH) < d - INTERVAL 3 MONTH
                  THEN date_trunc('month', d - INTERVAL 3 MONTH) + INTERVAL 1 MONTH
                  ELSE date_trunc('month', d - INTERVAL 3 MONTH) END AS w_low,
             date_trunc('month', d - INTERVAL 1 DAY) AS w_high FROM edge),
    old AS ({_MONTHLY.format(p='price')}), fresh AS ({_MONTHLY.format(p='price * 3')})
    SELECT old.* FROM old, bounds WHERE NOT (CAST(bucket AS DATE) >= w_low AND CAST(bucket AS DATE) < w_high)
    UNION ALL
    SELECT fresh.* FROM fresh, bounds WHERE CAST(bucket AS DATE) >= w_low AND CAST(bucket AS DATE) < w_high""")
def _refresh_rollup(spark, sf):
    # The base is fetched again with other prices; only the window follows.
    store = scratch_root(spark, "rollup")
    target = _loaded_bars(spark, sf, store)
    rollup.build_rollup(spark, target, "ohlcv_monthly")
    _loaded_bars(spark, sf, store, factor=3)
    base = PublishedTable(spark, target, TABLES["market_data_daily"].dataset())
    rollup.refresh_rollup(spark, target, "ohlcv_monthly", base.max_date())
    return shown(rollup.read_rollup(spark, target, "ohlcv_monthly"))


def _refresh_sql(unit: str, width: int, back: int, groups: str, measures: str) -> str:
    """A rollup whose base tripled, of which only the buckets of the refresh window follow."""
    rolled = f"""
        SELECT CAST(CAST(date_trunc('{unit}', date) AS DATE) AS VARCHAR) AS bucket, {groups}, {measures}
        FROM base GROUP BY ALL"""
    low = f"d - INTERVAL {back} MONTH"
    return f"""
    WITH base AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS label, o_orderstatus AS part,
                         CAST(sum(round(o_totalprice * 100)) AS DOUBLE) AS value
                  FROM orders GROUP BY ALL),
    edge AS (SELECT max(date) AS d FROM base),
    bounds AS (
      SELECT CASE WHEN date_trunc('{unit}', {low}) < {low} THEN date_trunc('{unit}', {low}) + INTERVAL {width} MONTH
                  ELSE date_trunc('{unit}', {low}) END AS w_low,
             date_trunc('{unit}', d - INTERVAL 1 DAY) AS w_high FROM edge),
    old AS ({rolled.format(f="value")}), fresh AS ({rolled.format(f="value * 3")})
    SELECT old.* FROM old, bounds WHERE NOT (CAST(bucket AS DATE) >= w_low AND CAST(bucket AS DATE) < w_high)
    UNION ALL
    SELECT fresh.* FROM fresh, bounds WHERE CAST(bucket AS DATE) >= w_low AND CAST(bucket AS DATE) < w_high"""


def _daily_values(spark, sf, keys: dict[str, Column]):
    """Order totals by day and ``keys``, as rows of a series table."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"), *[k.alias(n) for n, k in keys.items()],
        cents("o_totalprice").alias("value"),
    )
    rows = orders.groupBy("date", *keys).agg(F.sum("value").cast("double").alias("value"))
    return rows.withColumn("last_fetched_at", F.lit(BATCH_TS).cast("timestamp"))


def _refreshed(spark, sf, name: str, base: str, keys: dict[str, Column]):
    """Base table loaded, rolled up, loaded again with tripled values, refreshed by its newest date."""
    target = scratch_root(spark, name)
    rows = _daily_values(spark, sf, keys)
    load.load_table(spark, target, base, rows)
    rollup.build_rollup(spark, target, name)
    load.load_table(spark, target, base, rows.withColumn("value", F.col("value") * 3))
    newest = PublishedTable(spark, target, TABLES[base].dataset()).max_date()
    rollup.refresh_rollup(spark, target, name, newest)
    return shown(rollup.read_rollup(spark, target, name))


@query("refresh_rollup_yield", _refresh_sql(
    "month", 1, 3, "part AS component, label AS tenor",
    "avg({f}) AS avg_value, min({f}) AS min_value, max({f}) AS max_value, count(*) AS obs_count",
))
def _refresh_rollup_yield(spark, sf):
    label, part = F.col("o_orderpriority"), F.col("o_orderstatus")
    series = {"tenor": label, "component": part, "fred_series_id": F.concat(label, part)}
    return _refreshed(spark, sf, "yield_monthly", "fred_yield_curves", series)


@query("refresh_changed", """
    WITH base AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS tenor, o_orderstatus AS component,
                         CAST(sum(round(o_totalprice * 100)) AS DOUBLE) AS value
                  FROM orders GROUP BY ALL),
    edge AS (SELECT max(date) AS d FROM base),
    rolled AS (SELECT CAST(date_trunc('month', date) AS DATE) AS bucket, component, tenor, count(*) AS obs_count,
                      avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value
               FROM base GROUP BY ALL),
    judged AS (SELECT rolled.*, month(bucket) % 2 = 0 AND bucket >= d - INTERVAL 3 MONTH
                      AND bucket < date_trunc('month', d - INTERVAL 1 DAY) AS redone FROM rolled, edge)
    SELECT CAST(bucket AS VARCHAR) AS bucket, component, tenor, obs_count, redone,
           avg_value * f AS avg_value, min_value * f AS min_value, max_value * f AS max_value
    FROM (SELECT *, CASE WHEN redone THEN 3 ELSE 1 END AS f FROM judged)""")
def _refresh_changed(spark, sf):
    # The base comes again as it is, then with other values in even months: only these are redone.
    target = scratch_root(spark, "changed")
    name, base = "yield_monthly", "fred_yield_curves"
    label, part = F.col("o_orderpriority"), F.col("o_orderstatus")
    keys = {"tenor": label, "component": part, "fred_series_id": F.concat(label, part)}
    rows = _daily_values(spark, sf, keys)
    load.load_table(spark, target, base, rows)
    rollup.build_rollup(spark, target, name)
    newest = PublishedTable(spark, target, TABLES[base].dataset()).max_date()
    load.load_table(spark, target, base, rows)
    done = rollup.refresh_changed(spark, target, name, newest)
    even = F.col("value") * F.when(F.month("date") % 2 == 0, 3).otherwise(1)
    load.load_table(spark, target, base, rows.withColumn("value", even))
    done += rollup.refresh_changed(spark, target, name, newest)
    redone = F.col("bucket").isin(done) if done else F.lit(False)
    return shown(rollup.read_rollup(spark, target, name).withColumn("redone", redone))


@query("refresh_rollup_hicp", _refresh_sql(
    "month", 1, 6, "label || part AS series_label",
    "avg({f}) AS avg_value, last({f} ORDER BY date) AS latest_value, count(*) AS obs_count",
))
def _refresh_rollup_hicp(spark, sf):
    series = F.concat("o_orderpriority", "o_orderstatus")
    return _refreshed(spark, sf, "hicp_monthly", "ecb_hicp", {"series_label": series, "series_id": F.upper(series)})


@query("refresh_rollup_gdp", _refresh_sql(
    "quarter", 3, 24, "label || part AS country",
    "avg({f}) AS avg_gdp, last({f} ORDER BY date) AS latest_gdp, count(*) AS obs_count",
))
def _refresh_rollup_gdp(spark, sf):
    country = F.concat("o_orderpriority", "o_orderstatus")
    return _refreshed(spark, sf, "gdp_quarterly", "eurostat_gdp", {"country": country})


@query("retain_table", f"""
    WITH {_DAILY_BARS}
    SELECT ticker, CAST(date AS VARCHAR) AS date, price AS close FROM daily
    WHERE date >= (SELECT CAST(max(date) - INTERVAL 24 MONTH AS DATE) FROM daily)""")
def _retain_table(spark, sf):
    target = _loaded_bars(spark, sf, scratch_root(spark, "retain"))
    spec = TABLES["market_data_daily"]
    bars = PublishedTable(spark, target, spec.dataset())
    upkeep.retain(bars, spec.retain_months, bars.max_date())
    return shown(bars.read().select("ticker", "date", "close"))


@query("compact_table", f"""
    WITH {_DAILY_BARS},
    edge AS (SELECT date_trunc('month', max(date) - INTERVAL 3 MONTH) AS d FROM daily)
    SELECT CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS bucket, count(*) AS n,
           sum(price) AS total, date_trunc('month', date) < max(edge.d) AS compacted
    FROM daily, edge GROUP BY date_trunc('month', date)""")
def _compact_table(spark, sf):
    target = _loaded_bars(spark, sf, scratch_root(spark, "compact"))
    spec = TABLES["market_data_daily"]
    bars = PublishedTable(spark, target, spec.dataset())
    limit = upkeep.compact_limit(spec, bars.max_date())
    done = upkeep.compact(bars, limit, spec.segment_by)
    rows = bars.read(with_bucket=True).withColumnRenamed("__bucket", "bucket").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("close").alias("total")
    )
    return rows.withColumn("compacted", F.col("bucket").isin(done))


@query("ingest_bars", """
    SELECT ticker, date, price AS close, event_id AS transactions FROM (
      SELECT upper(event_type) AS ticker, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
             round(value * 100) AS price, event_id,
             row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC) AS rn
      FROM events)
    WHERE rn = 1""")
def _ingest_bars(spark, sf):
    # Landed JSON lines, one bar per ticker and day, through feed, merge, gate and store.
    from tidemark.plans.feeds import ingest

    root = scratch_root(spark, "landing")
    last = table(spark, sf, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(
        F.max_by(F.struct(cents("value").alias("close"), F.col("event_id").alias("transactions")), "ts").alias("bar")
    )
    millis = F.unix_date("day").cast("bigint") * 86_400_000
    last.select(F.col("event_type").alias("ticker"), millis.alias("timestamp"), "bar.*").write.json(
        f"{root}/landed/daily_bars"
    )
    ingest(spark, f"{root}/store", f"{root}/landed", "daily_bars", BATCH_TS)
    rows = save.read_dataset(spark, f"{root}/store", "daily_bars")
    return shown(rows.select("ticker", "date", "close", "transactions"))


@query("save_ticker_list", """
    SELECT p_type AS market, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS ticker, p_brand AS name FROM part""")
def _save_ticker_list(spark, sf):
    # The listing comes twice; the later names win.
    store = scratch_root(spark, "listing")
    for column, fetched in (("p_name", "2024-06-01"), ("p_brand", "2024-06-02")):
        batch = table(spark, sf, "part").select(
            F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("ticker"),
            F.col("p_type").alias("market"),
            F.col(column).alias("name"),
            F.lit(fetched).cast("timestamp").alias("last_fetched_at"),
        )
        save.save_by_item(spark, store, "ticker_list", batch)
    return save.read_dataset(spark, store, "ticker_list").select("market", "ticker", "name")


@query("read_dates", f"""
    WITH {_DAILY_BARS}
    SELECT ticker, CAST(date AS VARCHAR) AS date, price AS close FROM daily
    WHERE date BETWEEN DATE '1996-02-10' AND DATE '1996-05-20'""")
def _read_dates(spark, sf):
    import datetime as dt

    store = scratch_root(spark, "dates")
    save.save_dataset(spark, store, "daily_bars", _bar_batch(spark, sf))
    bars = PublishedTable(spark, store, save.DATASETS["daily_bars"])
    rows = bars.read_dates(dt.date(1996, 2, 10), dt.date(1996, 5, 20))
    return shown(rows.select("ticker", "date", "close"))


@query("state_log", """
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
    SELECT CAST(user_id AS VARCHAR) AS symbol, CASE event_type WHEN 'error' THEN 'failed' ELSE 'ok' END AS status
    FROM ranked WHERE rn = 1""")
def _state_log(spark, sf):
    from tidemark.operators.ledger import last_status

    path = f"{scratch_root(spark, 'state')}/log"
    log = table(spark, sf, "events").select(
        F.lit("POLYGON").alias("source"),
        F.lit("daily_bars").alias("dataset"),
        F.col("user_id").cast("string").alias("symbol"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        as_utc("ts").alias("timestamp"),
    )
    append_state(log.where("status = 'ok'"), path)
    append_state(log.where("status = 'failed'"), path)
    return last_status(read_state(spark, path)).select("symbol", "status")


DAILY_EVENTS = Dataset(
    "daily_events",
    table_schema("date DATE", "label STRING", "value DOUBLE", "event_id BIGINT", "last_fetched_at TIMESTAMP"),
    keys=("date", "label"),
    bucket_width="day",
    cluster_by=("label",),
)


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return landed_stream(spark, sf, schema, "parquet", pattern="events*.parquet")


@query("merge_stream", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS label,
           last(round(value * 100) ORDER BY ts) AS value, last(event_id ORDER BY ts) AS event_id
    FROM events GROUP BY 1, 2""")
def _merge_stream(spark, sf):
    store = scratch_root(spark, "stream")

    def shape(batch):
        return batch.select(
            F.col("ts").cast("date").alias("date"),
            F.col("event_type").alias("label"),
            cents("value").alias("value"),
            "event_id",
            as_utc("ts").alias("last_fetched_at"),
        )

    merge_stream(_event_stream(spark, sf), store, DAILY_EVENTS, f"{store}/checkpoint", shape).awaitTermination()
    return shown(PublishedTable(spark, store, DAILY_EVENTS).read().drop("last_fetched_at"))


DAILY_TOTALS = Dataset(
    "daily_totals",
    table_schema("bucket_start DATE", "event_type STRING", "total DOUBLE", "n BIGINT", "last_fetched_at TIMESTAMP"),
    keys=("bucket_start", "event_type"),
    gate=Gate(required=("bucket_start",), not_all_null=("bucket_start",), date_column="bucket_start"),
    date_column="bucket_start",
    bucket_width="month",
)


@query("bucket_stream", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS bucket_start, event_type,
           sum(round(value * 100)) AS total, count(*) AS n
    FROM events GROUP BY 1, 2""")
def _bucket_stream(spark, sf):
    store = scratch_root(spark, "buckets")
    measures = [F.sum(cents("value")).alias("total"), F.count(F.lit(1)).alias("n")]
    stream = _event_stream(spark, sf).withColumn("ts", as_utc("ts"))
    bucket_stream(
        stream, "ts", ["event_type"], measures, store, DAILY_TOTALS, f"{store}/checkpoint"
    ).awaitTermination()
    return shown(PublishedTable(spark, store, DAILY_TOTALS).read().drop("last_fetched_at"))


@query("refresh_touched", f"""
    WITH {_DAILY_BARS} {_MONTHLY.format(p='price')}""")
def _refresh_touched(spark, sf):
    # Calendar months follow a batch: those it touched are recomputed from the base.
    target = _loaded_bars(spark, sf, scratch_root(spark, "touched"))
    bars = PublishedTable(spark, target, TABLES["market_data_daily"].dataset())
    refresh_touched(bars, bars.read().select("date"), "ohlcv_monthly")
    return shown(rollup.read_rollup(spark, target, "ohlcv_monthly"))


__all__ = ["DAILY_EVENTS", "DAILY_TOTALS", "NOT_EMPTY", "ORDER_PRICES"]
