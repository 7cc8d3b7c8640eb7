"""Time buckets, rollups, windows, limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import first_by, last_by, time_bucket
from tidemark.operators.aggregate import ROLLUPS, gdp_quarterly, hicp_monthly, ohlcv, roll_up, yield_monthly
from tidemark.operators.limits import head, sample, sort_by_keys, tail
from tidemark.operators.merge import dedupe_grain, merge_latest
from tidemark.operators.project import (
    between_dates,
    incremental_since,
    incremental_since_by,
    incremental_start,
    max_date,
)
from tidemark.plans.rollup import window_rows
from tidemark.plans.upkeep import retained
from tidemark.workload.registry import BARS_SQL, cents, event_series, order_bars, query, shown, table

_OHLCV_SQL = """
    SELECT CAST(CAST(date_trunc('{width}', date) AS DATE) AS VARCHAR) AS bucket, ticker,
           first(price ORDER BY date, seq) AS open, max(price) AS high, min(price) AS low,
           last(price ORDER BY date, seq) AS close, sum(volume) AS total_volume,
           avg(price) AS avg_vwap, count(*) AS trading_days
    FROM bars GROUP BY 1, 2"""


@query("time_bucket", """
    SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_bucket,
           CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS quarter_bucket,
           CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR) AS year_bucket,
           count(*) AS n
    FROM orders GROUP BY 1, 2, 3""")
def _time_bucket(spark, sf):
    orders = table(spark, sf, "orders")
    buckets = [time_bucket(w, "o_orderdate").alias(f"{w}_bucket") for w in ("month", "quarter", "year")]
    return shown(orders.groupBy(*buckets).agg(F.count(F.lit(1)).alias("n")))


@query("ohlcv_monthly", f"WITH bars AS ({BARS_SQL})" + _OHLCV_SQL.format(width="month"))
def _ohlcv_monthly(spark, sf):
    return shown(ohlcv(order_bars(spark, sf), order=("date", "seq")))


@query("ohlcv_daily", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS bucket, event_type AS ticker,
           first(round(value * 100) ORDER BY ts) AS open, max(round(value * 100)) AS high,
           min(round(value * 100)) AS low, last(round(value * 100) ORDER BY ts) AS close,
           CAST(sum(user_id) AS DOUBLE) AS total_volume, avg(round(value * 100)) AS avg_vwap,
           count(*) AS trading_days
    FROM events GROUP BY 1, 2""")
def _ohlcv_daily(spark, sf):
    price = cents("value")
    bars = table(spark, sf, "events").select(
        F.col("event_type").alias("ticker"),
        F.col("ts").alias("date"),
        *[price.alias(c) for c in ("open", "high", "low", "close", "vwap")],
        F.col("user_id").cast("double").alias("volume"),
    )
    return shown(ohlcv(bars, width="day"))


@query("series_monthly", """
    SELECT CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS bucket,
           l_returnflag AS component, l_linestatus AS tenor,
           avg(round(l_extendedprice * 100)) AS avg_value,
           min(round(l_extendedprice * 100)) AS min_value,
           max(round(l_extendedprice * 100)) AS max_value, count(*) AS obs_count
    FROM lineitem GROUP BY 1, 2, 3""")
def _series_monthly(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("component"),
        F.col("l_linestatus").alias("tenor"),
        cents("l_extendedprice").alias("value"),
    )
    return shown(yield_monthly(rows))


@query("hicp_monthly", """
    SELECT CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS bucket,
           event_type AS series_label, avg(round(value * 100)) AS avg_value,
           last(round(value * 100) ORDER BY ts) AS latest_value, count(*) AS obs_count
    FROM events GROUP BY 1, 2""")
def _hicp_monthly(spark, sf):
    return shown(hicp_monthly(event_series(spark, sf), order=("ts",)))


@query("series_quarterly", f"""
    WITH bars AS ({BARS_SQL.replace('FROM orders', ', o_orderstatus AS country FROM orders')})
    SELECT CAST(CAST(date_trunc('quarter', date) AS DATE) AS VARCHAR) AS bucket, country,
           avg(price) AS avg_gdp, last(price ORDER BY date, seq) AS latest_gdp,
           count(*) AS obs_count
    FROM bars GROUP BY 1, 2""")
def _series_quarterly(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("country"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderkey").alias("seq"),
        cents("o_totalprice").alias("value"),
    )
    return shown(gdp_quarterly(rows, order=("date", "seq")))


@query("first_last_by", """
    SELECT event_type,
           first(CASE WHEN user_id > 50 THEN value END ORDER BY ts) AS first_value,
           last(CASE WHEN user_id > 50 THEN value END ORDER BY ts) AS last_value
    FROM events GROUP BY 1""")
def _first_last_by(spark, sf):
    # A null value at the first or last time stays null.
    value = F.when(F.col("user_id") > 50, F.col("value"))
    return table(spark, sf, "events").groupBy("event_type").agg(
        first_by(value, "ts").alias("first_value"), last_by(value, "ts").alias("last_value")
    )


@query("refresh_window", f"""
    WITH bars AS ({BARS_SQL}),
    edge AS (SELECT max(date) AS d FROM bars),
    bounds AS (
      SELECT CASE WHEN date_trunc('month', d - INTERVAL 3 MONTH) < d - INTERVAL 3 MONTH
                  THEN date_trunc('month', d - INTERVAL 3 MONTH) + INTERVAL 1 MONTH
                  ELSE date_trunc('month', d - INTERVAL 3 MONTH) END AS low,
             date_trunc('month', d - INTERVAL 1 DAY) AS high FROM edge)
    {_OHLCV_SQL.format(width='month').replace('FROM bars', 'FROM bars, bounds WHERE date >= low AND date < high')}""")
def _refresh_window(spark, sf):
    bars = order_bars(spark, sf)
    now = max_date(bars).first()["max_date"]
    rollup = ROLLUPS["ohlcv_monthly"]
    return shown(roll_up(window_rows(bars, rollup, now), rollup, order=("date", "seq")))


@query("max_date", "SELECT CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS max_date FROM orders")
def _max_date(spark, sf):
    return shown(max_date(order_bars(spark, sf)))


@query("incremental_start", """
    SELECT CAST(CAST(max(o_orderdate) AS DATE) - 7 AS VARCHAR) AS daily_start,
           CAST(CAST(date_trunc('month', CAST(max(o_orderdate) AS DATE) - 7) AS DATE) AS VARCHAR)
             AS monthly_start
    FROM orders""")
def _incremental_start(spark, sf):
    bars = order_bars(spark, sf)
    daily = incremental_start(bars, 7).withColumnRenamed("start_date", "daily_start")
    monthly = incremental_start(bars, 7, monthly=True).withColumnRenamed("start_date", "monthly_start")
    return shown(daily.join(monthly))


@query("incremental_since", """
    SELECT o_orderkey AS seq, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date
    FROM orders
    WHERE CAST(o_orderdate AS DATE) >= (SELECT CAST(max(l_shipdate) AS DATE) - 365 FROM lineitem)""")
def _incremental_since(spark, sf):
    stored = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return shown(incremental_since(stored, order_bars(spark, sf), 365).select("seq", "date"))


@query("incremental_since_by", """
    WITH starts AS (SELECT o_orderpriority AS p, CAST(max(o_orderdate) AS DATE) - 30 AS start
                    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT o_orderkey AS seq, o_orderpriority AS ticker
    FROM orders JOIN starts ON p = o_orderpriority
    WHERE CAST(o_orderdate AS DATE) >= start""")
def _incremental_since_by(spark, sf):
    stored = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("date").alias("date")
    )
    rows = incremental_since_by(stored, order_bars(spark, sf), "ticker", 30)
    return rows.select("seq", "ticker")


@query("between_dates", """
    SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, count(*) AS n,
           CAST(sum(l_quantity) AS DOUBLE) AS quantity
    FROM lineitem
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY 1""")
def _between_dates(spark, sf):
    rows = table(spark, sf, "lineitem")
    kept = between_dates(rows, "1996-01-01", "1998-12-31", "l_shipdate")
    return shown(
        kept.groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
        )
    )


@query("retain", """
    SELECT o_orderkey AS seq, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders
    WHERE CAST(o_orderdate AS DATE) >=
          (SELECT CAST(CAST(max(o_orderdate) AS DATE) - INTERVAL 24 MONTH AS DATE) FROM orders)""")
def _retain(spark, sf):
    bars = order_bars(spark, sf)
    now = max_date(bars).first()["max_date"]
    return shown(retained(bars, "date", 24, now).select("seq", "date"))



@query("merge_latest", """
    WITH stored AS (SELECT o_orderkey AS k, round(o_totalprice * 100) AS price,
                           CAST(o_orderdate AS TIMESTAMP) AS fetched, 0 AS is_new FROM orders),
    batch AS (SELECT o_orderkey AS k, round(o_totalprice * 100) + 1 AS price,
                     CASE o_orderstatus WHEN 'F' THEN o_orderdate + INTERVAL 1 DAY
                          WHEN 'O' THEN o_orderdate ELSE o_orderdate - INTERVAL 1 DAY END AS fetched,
                     1 AS is_new FROM orders),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY fetched DESC, is_new DESC) AS rn
               FROM (SELECT * FROM stored UNION ALL SELECT * FROM batch))
    SELECT k, price, strftime(fetched, '%Y-%m-%d %H:%M:%S') AS last_fetched_at
    FROM ranked WHERE rn = 1""")
def _merge_latest(spark, sf):
    # Finished orders were fetched again later, open ones at the same time,
    # pending ones come from an older fetch and must lose.
    stored = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("status"),
        cents("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("last_fetched_at"),
    )
    day = F.expr("INTERVAL 1 DAY")
    fetched = F.col("last_fetched_at")
    batch = stored.withColumn("price", F.col("price") + 1).withColumn(
        "last_fetched_at",
        F.when(F.col("status") == "F", fetched + day)
        .when(F.col("status") == "O", fetched)
        .otherwise(fetched - day),
    )
    merged = merge_latest(stored, batch, ["k"]).drop("status")
    return shown(merged)


@query("dedupe_grain", """
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events)
    WHERE rn = 1""")
def _dedupe_grain(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    newest = dedupe_grain(events, ["user_id", "event_type"], fetched_at="ts")
    return newest.drop("ts")


@query("sort_by_keys", """
    SELECT o_orderpriority AS tenor, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1""")
def _sort_by_keys(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("tenor")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return sort_by_keys(counts, "tenor")


_ORDER_COLUMNS = "o_orderkey, o_custkey, o_totalprice"


@query("head", f"SELECT {_ORDER_COLUMNS} FROM orders ORDER BY o_orderkey LIMIT 10")
def _head(spark, sf):
    return head(table(spark, sf, "orders").select(*_ORDER_COLUMNS.split(", ")), 10, "o_orderkey")


@query("tail", f"""
    SELECT * FROM (SELECT {_ORDER_COLUMNS} FROM orders ORDER BY o_orderkey DESC LIMIT 10)
    ORDER BY o_orderkey""")
def _tail(spark, sf):
    return tail(table(spark, sf, "orders").select(*_ORDER_COLUMNS.split(", ")), 10, "o_orderkey")


@query("sample", f"""
    SELECT {_ORDER_COLUMNS} FROM orders
    ORDER BY md5('7|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100""")
def _sample(spark, sf):
    return sample(table(spark, sf, "orders").select(*_ORDER_COLUMNS.split(", ")), 100, 7, "o_orderkey")


@query("merge_latest_ohlcv", f"""
    WITH bars AS ({BARS_SQL.replace('round(o_totalprice * 100)',
        "round(o_totalprice * 100) + CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 7 END")})
    {_OHLCV_SQL.format(width='month')}""")
def _merge_latest_ohlcv(spark, sf):
    # Bars of two fetches; pending orders were not fetched again later.
    def fetch(bump: int, hours: int):
        price = cents("o_totalprice") + bump
        late = F.when(F.col("o_orderstatus") == "P", F.lit(-1)).otherwise(F.lit(hours))
        return table(spark, sf, "orders").select(
            F.col("o_orderpriority").alias("ticker"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_orderkey").alias("seq"),
            *[price.alias(c) for c in ("open", "high", "low", "close", "vwap")],
            F.col("o_custkey").cast("double").alias("volume"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), late * bump)).alias("last_fetched_at"),
        )

    merged = merge_latest(fetch(0, 0), fetch(7, 1), ["seq"])
    return shown(ohlcv(merged, order=("date", "seq")))
