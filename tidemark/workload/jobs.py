"""The jobs around the operators: what they keep, set aside and report."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.catalog import DATASETS
from tidemark.plans import feeds, load, save
from tidemark.plans.outcomes import read_outcomes
from tidemark.plans.rejects import read_rejects
from tidemark.session import scratch_root
from tidemark.sinks.published import PublishedTable
from tidemark.sources.landed import read_landed_table
from tidemark.workload.registry import BATCH_TS, cents, query, table
from tidemark.workload.stored import _DAILY_BARS, _bar_batch


@query("save_by_item_failing", f"""
    WITH {_DAILY_BARS}
    SELECT ticker, count(*) AS n, sum(price * CASE ticker WHEN '3-MEDIUM' THEN 1 ELSE 3 END) AS total
    FROM daily GROUP BY 1""")
def _save_by_item_failing(spark, sf):
    # The second batch of one ticker breaks its date bound: its stored rows stay as they are.
    store, bars = scratch_root(spark, "failing-items"), DATASETS["daily_bars"]
    dataset = replace(bars, gate=replace(bars.gate, min_date="1900-01-01"))
    save.save_by_item(spark, store, dataset, _bar_batch(spark, sf))
    again = _bar_batch(spark, sf, factor=3)
    bad = again.where("ticker = '3-MEDIUM'").withColumn("date", F.lit("1800-01-01").cast("date"))
    save.save_by_item(spark, store, dataset, again.unionByName(bad))
    rows = PublishedTable(spark, store, dataset).read()
    return rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.sum("close").alias("total"))


@query("ingest_listing", """
    SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS ticker, p_type AS market, p_name AS name,
           CAST(p_size AS VARCHAR) AS size
    FROM part""")
def _ingest_listing(spark, sf):
    # All markets and all fields of what has landed are kept.
    root = scratch_root(spark, "listing")
    entry = F.struct(
        F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("ticker"), F.col("p_type").alias("market"),
        F.col("p_name").alias("name"), F.col("p_size").alias("size"),
    )
    table(spark, sf, "part").select(F.to_json(entry)).write.text(f"{root}/landing/ticker_list")
    feeds.ingest(spark, f"{root}/store", f"{root}/landing", "ticker_list", BATCH_TS)
    rows = save.read_dataset(spark, f"{root}/store", "ticker_list")
    return rows.select("ticker", "market", "name", F.col("extra")["size"].alias("size"))


@query("periods_two_headers", """
    SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN round(c_acctbal * 100) END AS jan,
           round(c_acctbal * 100) + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS feb,
           CASE WHEN c_custkey % 2 = 1 THEN round(c_acctbal * 100) + 1 END AS mar
    FROM customer""")
def _periods_two_headers(spark, sf):
    # Two files whose period columns are shifted by a month, the key last in one of them.
    folder = scratch_root(spark, "headers")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), cents("c_acctbal").alias("x"))
    first = rows.where("k % 2 = 0").select("k", F.col("x").alias("2024-01"), (F.col("x") + 1).alias("2024-02"))
    other = rows.where("k % 2 = 1").select(F.col("x").alias("2024-02"), (F.col("x") + 1).alias("2024-03"), "k")
    for part in (first, other):
        part.write.mode("append").option("header", "true").csv(folder)
    read = read_landed_table(spark, folder)
    return read.select(
        F.col("k").cast("bigint").alias("k"), F.col("`2024-01`").cast("double").alias("jan"),
        F.col("`2024-02`").cast("double").alias("feb"), F.col("`2024-03`").cast("double").alias("mar"),
    )


@query("ingest_ledger", """
    WITH types AS (SELECT DISTINCT event_type AS t FROM events),
    ends AS (SELECT min(t) AS low, max(t) AS high FROM types)
    SELECT upper(t) AS item, CASE WHEN t IN (low, high) THEN 'failed' ELSE 'saved' END AS status,
           CASE WHEN t = low THEN 'no timestamp' WHEN t = high THEN 'limit reached' END AS reason
    FROM types, ends
    UNION ALL SELECT upper(n_name), 'skipped', 'no rows' FROM nation""")
def _ingest_ledger(spark, sf):
    # One symbol sends lines without a time, one a refusal; the nations did not land.
    root = scratch_root(spark, "ledger")
    events = table(spark, sf, "events")
    low, high = events.agg(F.min("event_type"), F.max("event_type")).first()
    kind = F.col("event_type")
    line = F.to_json(F.struct(
        kind.alias("ticker"),
        F.when(kind != low, F.unix_millis(F.col("ts").cast("timestamp"))).alias("timestamp"),
        cents("value").alias("close"),
        F.when(kind == high, F.lit("limit reached")).alias("Note"),
    ))
    refused = F.to_json(F.struct(kind.alias("ticker"), F.lit("limit reached").alias("Note")))
    lines = events.select(F.when(kind == high, refused).otherwise(line))
    lines.write.text(f"{root}/landing/daily_bars")
    asked = [r[0] for r in events.select("event_type").distinct().collect()]
    asked += [r[0] for r in table(spark, sf, "nation").select("n_name").collect()]
    ledger = feeds.ingest(spark, f"{root}/store", f"{root}/landing", "daily_bars", BATCH_TS, items=asked)
    return ledger.select("item", "status", "reason")


@query("ingest_rejects", """
    WITH e AS (SELECT upper(event_type) AS item, CASE WHEN event_id % 13 = 0 THEN 'not JSON'
                 WHEN event_id % 11 = 0 THEN 'no timestamp' WHEN event_id % 7 = 0 THEN 'bad timestamp' END AS reason FROM events),
    named AS (SELECT CASE WHEN reason = 'not JSON' THEN '?' ELSE item END AS item, reason FROM e)
    SELECT item, reason, count(*) AS lines, count(*) AS places FROM named WHERE reason IS NOT NULL GROUP BY ALL
    UNION ALL SELECT item, 'landed', count(*), count(reason) FROM named GROUP BY item""")
def _ingest_rejects(spark, sf):
    # Good and bad lines of the same tickers; each bad line is kept with its place, and all lines are counted.
    root = scratch_root(spark, "rejects")
    number = F.col("event_id")
    time = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    line = F.to_json(F.struct(
        F.col("event_type").alias("ticker"),
        F.when(number % 11 == 0, F.lit(None)).when(number % 7 == 0, F.lit("soon")).otherwise(time).alias("timestamp"),
        cents("value").alias("close"),
    ))
    lines = table(spark, sf, "events").select(F.when(number % 13 == 0, F.lit('{"ticker": "x", "clo')).otherwise(line))
    lines.write.text(f"{root}/landing/daily_bars")
    feeds.ingest(spark, f"{root}/store", f"{root}/landing", "daily_bars", BATCH_TS, run_id="run-1")
    rejects = read_rejects(spark, f"{root}/store", "run-1")
    found = rejects.groupBy(F.coalesce("item", F.lit("?")).alias("item"), "reason").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("file", "block", "line").alias("places")
    )
    counts = read_outcomes(spark, f"{root}/store", "run-1")
    return found.unionByName(counts.select(
        "item", F.lit("landed").alias("reason"), F.col("landed").alias("lines"), F.col("rejected").alias("places")
    ))


@query("load_constraints", """
    WITH counts AS (
        SELECT count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS nulls, count(*) AS n,
               count(DISTINCT (o_orderpriority, CAST(o_orderdate AS DATE)))
                 FILTER (WHERE o_orderpriority <> '3-MEDIUM') AS kept
        FROM orders)
    SELECT 'market_data_daily' AS "table", 'loaded' AS status, kept AS rows,
           'set aside: ' || nulls || ' rows with null keys, ' || (n - nulls - kept) || ' rows with repeated keys' AS reason
    FROM counts""")
def _load_constraints(spark, sf):
    # Rows without a date and rows that repeat a key do not reach the table, and are counted.
    batch = _bar_batch(spark, sf, hollow="3-MEDIUM")
    done = load.load_table(spark, scratch_root(spark, "constraints"), "market_data_daily", batch)
    return spark.createDataFrame([done], load.LOAD_SCHEMA).drop("columns")
