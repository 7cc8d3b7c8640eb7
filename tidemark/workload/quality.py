"""Gates, profiles, ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import OPTIONS_GATE, Gate
from tidemark.operators.ledger import failed_symbols, last_status, run_items, run_report, task_report
from tidemark.operators.profile import column_stats, dataset_summary, null_profile, numeric_summary
from tidemark.operators.quality import (
    constraint_report,
    failing_items,
    gate_report,
    gate_report_by,
)
from tidemark.functions import percent
from tidemark.plans.load import frame_counts
from tidemark.workload.registry import TABLES, cents, query, shown, table


@query("gate_report", """
    WITH m AS (SELECT count(*) AS n, CAST(min(o_orderdate) AS DATE) AS low,
                      CAST(max(o_orderdate) AS DATE) AS high FROM orders)
    SELECT 'not_empty' AS "check", n > 0 AS ok, 'rows > 0' AS expected, CAST(n AS VARCHAR) AS actual FROM m
    UNION ALL SELECT 'row_count', n >= 1 AND n <= 100, '>= 1, <= 100', CAST(n AS VARCHAR) FROM m
    UNION ALL SELECT 'required_columns', false, 'date,ticker', 'missing: ticker' FROM m
    UNION ALL SELECT 'not_all_null', false, 'date,hollow', 'all null: hollow' FROM m
    UNION ALL SELECT 'min_date', low >= DATE '1995-06-01', '>= 1995-06-01', CAST(low AS VARCHAR) FROM m
    UNION ALL SELECT 'max_date', high <= DATE '2030-01-01', '<= 2030-01-01', CAST(high AS VARCHAR) FROM m""")
def _gate_report(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"), F.lit(None).cast("double").alias("hollow")
    )
    gate = Gate(
        required=("date", "ticker"),
        not_all_null=("date", "hollow"),
        max_rows=100,
        min_date="1995-06-01",
        max_date="2030-01-01",
    )
    return gate_report(orders, gate)


def _keyed_orders(spark, sf):
    """Orders by priority; one priority has no dates at all."""
    date = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("ticker"), date.alias("date")
    )


@query("gate_by_item", """
    WITH m AS (SELECT o_orderpriority AS ticker, count(*) AS n FROM orders GROUP BY 1)
    SELECT ticker, 'not_empty' AS "check", true AS ok FROM m
    UNION ALL SELECT ticker, 'row_count', true FROM m
    UNION ALL SELECT ticker, 'required_columns', true FROM m
    UNION ALL SELECT ticker, 'not_all_null', ticker <> '3-MEDIUM' FROM m""")
def _gate_by_item(spark, sf):
    return gate_report_by(_keyed_orders(spark, sf), "ticker", Gate()).select("ticker", "check", "ok")


@query("gate_options", """
    SELECT unnest(['not_empty', 'row_count', 'required_columns', 'not_all_null']) AS "check",
           unnest([count(*) > 0, count(*) >= 1, true, count(l_shipdate) > 0]) AS ok
    FROM lineitem""")
def _gate_options(spark, sf):
    # Line items as contracts, against the gate of the option chain.
    chain = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("underlying"),
        F.col("l_linestatus").alias("type"),
        F.col("l_shipdate").cast("date").alias("expiry"),
        F.col("l_partkey").cast("string").alias("contract_symbol"),
        F.col("l_extendedprice").alias("strike"),
        F.col("l_shipdate").alias("snapshot_ts"),
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
    )
    return gate_report(chain, OPTIONS_GATE).select("check", "ok")


@query("failing_items", "SELECT '3-MEDIUM' AS ticker, 'not_all_null: all null: date' AS reason")
def _failing_items(spark, sf):
    return failing_items(_keyed_orders(spark, sf), "ticker", Gate())


@query("constraint_report", """
    SELECT 'not_null:l_orderkey' AS "check", CAST(count(*) - count(l_orderkey) AS BIGINT) AS violations,
           count(*) = count(l_orderkey) AS ok FROM lineitem
    UNION ALL
    SELECT 'not_null:l_tax', count(CASE WHEN l_tax = 0 THEN 1 END), count(CASE WHEN l_tax = 0 THEN 1 END) = 0
    FROM lineitem
    UNION ALL
    SELECT 'primary_key:l_orderkey,l_linenumber', count(*), count(*) = 0
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def _constraint_report(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax")
    )
    return constraint_report(lines, ["l_orderkey", "l_tax"], ["l_orderkey", "l_linenumber"])


_PROFILED = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
    "flag": "boolean",
}


def _profiled_events(spark, sf):
    """Events with nulls in some columns and a flag."""
    error = F.col("event_type") == "error"
    return table(spark, sf, "events").withColumns(
        {
            "value": F.when(~error, cents("value")),
            "props": F.when(F.col("user_id") > 50, F.col("props")),
            "flag": F.when(~error, F.col("user_id") > 20),
        }
    )


_PROFILED_SQL = """
    WITH e AS (SELECT event_id, ts, user_id, event_type,
                      CASE WHEN event_type <> 'error' THEN round(value * 100) END AS value,
                      CASE WHEN user_id > 50 THEN props END AS props,
                      CASE WHEN event_type <> 'error' THEN user_id > 20 END AS flag FROM events)"""


@query("null_profile", _PROFILED_SQL + " UNION ALL ".join(
    f"""
    SELECT {i} AS position, '{c}' AS "column", '{t}' AS type, count(*) - count({c}) AS null_count,
           count({c}) AS non_null_count, (count(*) - count({c})) * 100.0 / count(*) AS null_percent FROM e"""
    for i, (c, t) in enumerate(_PROFILED.items(), 1)
))
def _null_profile(spark, sf):
    return null_profile(_profiled_events(spark, sf))


def _stats_sql(i: int, column: str, kind: str) -> str:
    none, text = "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    if kind in ("bigint", "double"):
        label, cells = "value", [
            f"CAST(min({column}) AS DOUBLE)", f"CAST(max({column}) AS DOUBLE)",
            f"CAST(sum({column}) AS DOUBLE) / count({column})", text, text,
        ]
    elif kind == "timestamp_ntz":
        label, cells = "time", [
            none, none, none, f"rtrim(CAST(min({column}) AS VARCHAR), '0')",
            f"rtrim(CAST(max({column}) AS VARCHAR), '0')",
        ]
    elif kind == "boolean":
        label, cells = "percent_true", [
            none, none, f"count(CASE WHEN {column} THEN 1 END) * 100.0 / count({column})", text, text,
        ]
    else:
        label, cells = "length", [
            f"CAST(min(length({column})) AS DOUBLE)", f"CAST(max(length({column})) AS DOUBLE)", none, text, text,
        ]
    names = ("min_number", "max_number", "mean_number", "min_time", "max_time")
    return f"""
    SELECT {i} AS position, '{column}' AS "column", '{kind}' AS type, '{label}' AS kind,
           count(*) - count({column}) AS nulls,
           count(DISTINCT {column}) + CASE WHEN count(*) > count({column}) THEN 1 ELSE 0 END AS uniques,
           {', '.join(f'{cell} AS {name}' for cell, name in zip(cells, names))} FROM e"""


@query("column_stats", _PROFILED_SQL + " UNION ALL ".join(
    _stats_sql(i, c, t) for i, (c, t) in enumerate(_PROFILED.items(), 1)
))
def _column_stats(spark, sf):
    return column_stats(_profiled_events(spark, sf))


@query("column_stats_text", " UNION ALL ".join(
    _stats_sql(i, c, t).replace("FROM e", "FROM documents")
    for i, (c, t) in enumerate(
        {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}.items(), 1
    )
))
def _column_stats_text(spark, sf):
    return column_stats(table(spark, sf, "documents"))


@query("numeric_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
               round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std FROM customer"""
    for c in ("c_custkey", "c_nationkey", "c_acctbal")
))
def _numeric_summary(spark, sf):
    rows = numeric_summary(table(spark, sf, "customer"))
    return rows.withColumns({c: F.round(c, 3) for c in ("mean", "std")})


@query("dataset_summary", """
    SELECT 'rows' AS part, CAST(count(*) AS DOUBLE) AS value FROM supplier
    UNION ALL SELECT 'columns', 4 FROM supplier GROUP BY 1, 2
    UNION ALL SELECT 'uniques:s_nationkey', count(DISTINCT s_nationkey) FROM supplier
    UNION ALL SELECT 'preview', count(*) FROM (SELECT * FROM supplier LIMIT 10)
    UNION ALL SELECT 'max:s_suppkey', max(s_suppkey) FROM supplier""")
def _dataset_summary(spark, sf):
    parts = dataset_summary(table(spark, sf, "supplier"), ["s_suppkey"])
    header, overview = parts["header"], parts["overview"].where("column = 's_nationkey'")
    numeric = parts["numeric"].where("column = 's_suppkey'")
    cells = [
        header.select(F.lit("rows").alias("part"), F.col("rows").cast("double").alias("value")),
        header.select(F.lit("columns"), F.col("columns").cast("double")),
        overview.select(F.lit("uniques:s_nationkey"), F.col("uniques").cast("double")),
        parts["preview"].agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("preview"), "value"),
        numeric.select(F.lit("max:s_suppkey"), "max"),
    ]
    out = cells[0]
    for cell in cells[1:]:
        out = out.union(cell)
    return out


@query("percentages", """
    SELECT lang, (count(*) - count(CASE WHEN n_chars > 500 THEN 1 END)) * 100.0 / count(*) AS short_percent
    FROM documents GROUP BY 1""")
def _percentages(spark, sf):
    long = F.count_if(F.col("n_chars") > 500)
    rows = F.count(F.lit(1))
    return table(spark, sf, "documents").groupBy("lang").agg(
        percent(rows - long, rows).alias("short_percent")
    )


@query("table_counts", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", count(*) AS rows FROM {t}""" for t in TABLES
))
def _table_counts(spark, sf):
    return frame_counts({t: table(spark, sf, t) for t in TABLES})


def _state_log(spark, sf):
    """Events as a fetch log: an error is a failed fetch."""
    status = F.when(F.col("event_type") == "error", "failed").otherwise("ok")
    return table(spark, sf, "events").select(
        F.lit("POLYGON").alias("source"),
        F.lit("daily_bars").alias("dataset"),
        F.col("user_id").cast("string").alias("symbol"),
        status.alias("status"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )


_STATE_SQL = """
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                    FROM events)"""


@query("last_status", _STATE_SQL + """
    SELECT 'POLYGON' AS source, 'daily_bars' AS dataset, CAST(user_id AS VARCHAR) AS symbol,
           CASE event_type WHEN 'error' THEN 'failed' ELSE 'ok' END AS status, event_id AS seq
    FROM ranked WHERE rn = 1""")
def _last_status(spark, sf):
    return last_status(_state_log(spark, sf), order=("timestamp", "seq")).drop("timestamp")


@query("failed_symbols", _STATE_SQL + """
    SELECT CAST(user_id AS VARCHAR) AS symbol FROM ranked WHERE rn = 1 AND event_type = 'error'""")
def _failed_symbols(spark, sf):
    log = _state_log(spark, sf)
    return failed_symbols(log, "POLYGON", "daily_bars", order=("timestamp", "seq"))


def _run_ledger(spark, sf):
    """Orders as a run ledger: a run per priority, an item per order."""
    names = {"O": "saved", "F": "failed", "P": "skipped"}
    status = F.element_at(
        F.create_map(*[F.lit(x) for p in names.items() for x in p]), F.col("o_orderstatus")
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("run_id"),
        F.lit("daily_bars").alias("dataset"),
        F.col("o_orderkey").cast("string").alias("item"),
        status.alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.lit("gate")).alias("reason"),
    )


@query("run_report", """
    SELECT o_orderpriority AS run_id, count(*) AS total,
           count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS saved,
           count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS failed,
           count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS skipped,
           count(CASE WHEN o_orderstatus = 'F' THEN 1 END) = 0 AS ok
    FROM orders GROUP BY 1""")
def _run_report(spark, sf):
    return run_report(_run_ledger(spark, sf))


@query("run_items", """
    SELECT o_orderpriority AS run_id, 'daily_bars' AS dataset, CAST(o_orderkey AS VARCHAR) AS item,
           'gate' AS reason FROM orders WHERE o_orderstatus = 'F'""")
def _run_items(spark, sf):
    return run_items(_run_ledger(spark, sf), "failed")


@query("task_report", """
    SELECT event_type AS run_id, count(*) AS tasks_run,
           count(CASE WHEN user_id > 90 THEN 1 END) AS tasks_failed,
           count(CASE WHEN user_id > 90 THEN 1 END) = 0 AS ok,
           strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_time,
           strftime(max(ts) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS end_time,
           (epoch_us(max(ts) + INTERVAL 1 MINUTE) - epoch_us(min(ts))) / 1e6 AS duration_seconds
    FROM events GROUP BY 1""")
def _task_report(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("event_type").alias("run_id"),
        F.col("event_id").cast("string").alias("task"),
        F.when(F.col("user_id") > 90, "failed").otherwise("success").alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("finished_at"),
    )
    return shown(task_report(log))
