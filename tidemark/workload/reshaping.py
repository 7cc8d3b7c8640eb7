"""Unions, joins, projections, long and wide forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.catalog import DATASETS
from tidemark.operators.joins import requested_vs_available
from tidemark.operators.limits import sort_by_keys
from tidemark.operators.merge import upsert
from tidemark.operators.project import (
    conform,
    dimension_filter,
    drop_null_obs,
    intersect_columns,
    prefix_columns,
    read_by_key,
    rename,
    select_series,
    with_audit,
)
from tidemark.operators.reshape import (
    chains_to_long,
    curve_to_long,
    curve_wide,
    fill_failed_series,
    full_curve,
    map_series_id,
    merge_series,
    periods_to_long,
    single_curve,
)
from tidemark.operators.union import relaxed_union
from tidemark.workload.registry import BATCH_TS, cents, event_series, query, shown, table


@query("relaxed_union", """
    SELECT CAST(o_orderkey AS DOUBLE) AS id, o_orderpriority AS label,
           CAST(o_totalprice AS VARCHAR) IS NOT NULL AS has_note, NULL AS extra
    FROM orders
    UNION ALL
    SELECT p_retailprice, CAST(p_size AS VARCHAR), p_type IS NOT NULL, p_brand FROM part""")
def _relaxed_union(spark, sf):
    # long meets double, text meets int, and one side lacks a column.
    left = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("label"),
        F.col("o_totalprice").alias("note"),
    )
    right = table(spark, sf, "part").select(
        F.col("p_retailprice").alias("id"),
        F.col("p_size").alias("label"),
        F.col("p_type").alias("note"),
        F.col("p_brand").alias("extra"),
    )
    both = relaxed_union(left, right)
    return both.select("id", "label", F.col("note").isNotNull().alias("has_note"), "extra")


@query("with_audit", f"""
    SELECT s_suppkey, 'FRED' AS source, '{BATCH_TS}' AS last_fetched_at, 'spot' AS component
    FROM supplier""")
def _with_audit(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey")
    return shown(with_audit(rows, K.SOURCE_FRED, BATCH_TS, component="spot"))


@query("rename_prefix", """
    SELECT n_nationkey AS date, n_name AS ZC_name, n_regionkey AS ZC_region FROM nation""")
def _rename_prefix(spark, sf):
    names = {"n_nationkey": "date", "n_name": "name", "n_regionkey": "region"}
    return prefix_columns(rename(table(spark, sf, "nation"), names), "ZC_")


@query("conform", """
    SELECT CAST(p_partkey AS VARCHAR) AS ticker, CAST(NULL AS VARCHAR) AS missing,
           CAST(p_size AS DOUBLE) AS size, CAST(NULL AS BIGINT) AS name
    FROM part""")
def _conform(spark, sf):
    from pyspark.sql import types as T

    rows = rename(table(spark, sf, "part"), {"p_partkey": "ticker", "p_size": "size", "p_name": "name"})
    schema = T.StructType.fromDDL("ticker STRING, missing STRING, size DOUBLE, name BIGINT")
    return conform(rows, schema, lenient=True)


@query("intersect_columns", "SELECT c_acctbal, c_custkey, c_mktsegment FROM customer")
def _intersect_columns(spark, sf):
    target = ["c_acctbal", "c_phone", "c_custkey", "c_comment", "c_mktsegment"]
    return intersect_columns(table(spark, sf, "customer"), target)


@query("drop_null_obs", """
    SELECT event_id, round(value * 100) AS value FROM events
    WHERE event_type <> 'error' AND user_id > 10""")
def _drop_null_obs(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("ts").cast("date")).alias("date"),
        F.when(F.col("user_id") > 10, cents("value")).alias("value"),
    )
    return drop_null_obs(rows).drop("date")


@query("read_by_key", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def _read_by_key(spark, sf):
    rows = read_by_key(table(spark, sf, "customer"), "c_mktsegment", "building")
    return rows.select("c_custkey", "c_name")


@query("select_series", """
    SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY 1""")
def _select_series(spark, sf):
    known = ["view", "click", "signup", "purchase", "error"]
    rows = select_series(table(spark, sf, "events"), ["view", "click"], "event_type", known)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("dimension_filter", """
    SELECT l_linenumber, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem
    WHERE l_returnflag = 'A' AND l_linestatus IN ('O', 'F') GROUP BY 1""")
def _dimension_filter(spark, sf):
    rows = dimension_filter(
        table(spark, sf, "lineitem"), {"l_returnflag": "A", "l_linestatus": ["O", "F"]}
    )
    return rows.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


_TENOR_SQL = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '1Y' WHEN '2' THEN '2Y'
                WHEN '3' THEN '3Y' WHEN '4' THEN '5Y' ELSE '7Y' END"""


def tenor_column():
    """Order priority as a tenor both the quoted and the fitted curves have."""
    first = F.substring("o_orderpriority", 1, 1)
    names = {"1": "1Y", "2": "2Y", "3": "3Y", "4": "5Y", "5": "7Y"}
    return F.element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), first)


def component_column():
    """Order status as a curve component."""
    names = {"F": "constant_maturity", "O": "zero_coupon", "P": "instantaneous_forward"}
    return F.element_at(
        F.create_map(*[F.lit(x) for p in names.items() for x in p]), F.col("o_orderstatus")
    )


@query("map_series_id", f"""
    SELECT {_TENOR_SQL} AS tenor, 'DGS' || substr({_TENOR_SQL}, 1, 1) AS fred_series_id,
           count(*) AS n
    FROM orders GROUP BY ALL""")
def _map_series_id(spark, sf):
    rows = table(spark, sf, "orders").select(tenor_column().alias("tenor"))
    mapped = map_series_id(rows, K.CONSTANT_MATURITY)
    return mapped.groupBy("tenor", "fred_series_id").agg(F.count(F.lit(1)).alias("n"))


@query("requested_vs_available", """
    SELECT c_custkey AS custkey,
           EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS found
    FROM customer""")
def _requested_vs_available(spark, sf):
    requested = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    available = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("custkey")
    )
    found, missing = requested_vs_available(requested, available, "custkey")
    return found.withColumn("found", F.lit(True)).unionByName(
        missing.withColumn("found", F.lit(False))
    )


@query("curve_to_long", """
    WITH days AS (
      SELECT CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS DOUBLE) AS q,
             sum(round(l_extendedprice * 100)) AS p,
             sum(CASE WHEN l_discount >= 0.1 THEN round(l_discount * 100) END) AS d
      FROM lineitem GROUP BY 1)
    SELECT CAST(date AS VARCHAR) AS date, tenor, value, fred_series_id, 'constant_maturity' AS component
    FROM (SELECT date, '1M' AS tenor, q AS value, 'DGS1MO' AS fred_series_id FROM days
          UNION ALL SELECT date, '1Y', p, 'DGS1' FROM days
          UNION ALL SELECT date, '10Y', d, 'DGS10' FROM days)""")
def _curve_to_long(spark, sf):
    high = F.when(F.col("l_discount") >= 0.1, cents("l_discount"))
    wide = table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
        F.sum("l_quantity").alias("1M"),
        F.sum(cents("l_extendedprice")).alias("1Y"),
        F.sum(high).alias("10Y"),
    )
    long = curve_to_long(wide, K.CONSTANT_MATURITY, "constant_maturity", BATCH_TS)
    return shown(long.drop("source", "last_fetched_at"))


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
_DAILY_SQL = """SELECT CAST(ts AS DATE) AS date, event_type, sum(round(value * 100)) AS value
                FROM events GROUP BY 1, 2"""


def _daily_events(spark, sf):
    return event_series(spark, sf).groupBy("date", "series_label").agg(F.sum("value").alias("value"))


@query("curve_wide", f"""
    WITH daily AS ({_DAILY_SQL})
    SELECT CAST(date AS VARCHAR) AS date,
           {', '.join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in _EVENT_TYPES)},
           CAST(NULL AS DOUBLE) AS refund
    FROM daily GROUP BY 1""")
def _curve_wide(spark, sf):
    return shown(curve_wide(_daily_events(spark, sf), [*_EVENT_TYPES, "refund"], tenor="series_label"))


@query("curve_newest", """
    WITH newest AS (SELECT CAST(ts AS DATE) AS date, event_type,
                           last(round(value * 100) ORDER BY ts) AS value FROM events GROUP BY 1, 2)
    SELECT CAST(date AS VARCHAR) AS date,
           max(CASE WHEN event_type = 'click' THEN value END) AS click,
           max(CASE WHEN event_type = 'view' THEN value END) AS view
    FROM newest GROUP BY 1""")
def _curve_newest(spark, sf):
    # A series that repeats on a date gives the value fetched last, not more rows.
    rows = event_series(spark, sf)
    return shown(curve_wide(rows, ["click", "view"], tenor="series_label", newest_by="ts"))


@query("merge_series", f"""
    WITH daily AS ({_DAILY_SQL}),
    a AS (SELECT date, value AS click FROM daily WHERE event_type = 'click' AND value > 20000),
    b AS (SELECT date, value AS view FROM daily WHERE event_type = 'view' AND value < 40000),
    c AS (SELECT date, value AS error FROM daily WHERE event_type = 'error' AND value > 25000)
    SELECT CAST(coalesce(a.date, b.date, c.date) AS VARCHAR) AS date, click, view, error,
           CAST(NULL AS DOUBLE) AS refund
    FROM a FULL OUTER JOIN b ON a.date = b.date
    FULL OUTER JOIN c ON c.date = coalesce(a.date, b.date)""")
def _merge_series(spark, sf):
    daily = _daily_events(spark, sf)
    limits = {
        "click": F.col("value") > 20000,
        "view": F.col("value") < 40000,
        "error": F.col("value") > 25000,
    }
    frames = [
        daily.where((F.col("series_label") == name) & kept).select(
            "date", F.col("value").alias(name)
        )
        for name, kept in limits.items()
    ]
    merged = merge_series(frames, limits)
    return shown(fill_failed_series(sort_by_keys(merged, "date"), ["click", "refund"]))


def curve_rows(spark, sf):
    """Orders as long curve rows: one value per date, tenor and component."""
    return table(spark, sf, "orders").groupBy(
        F.col("o_orderdate").cast("date").alias("date"),
        component_column().alias("component"),
        tenor_column().alias("tenor"),
    ).agg(F.max(cents("o_totalprice")).alias("value"))


_CURVE_SQL = f"""
    SELECT CAST(o_orderdate AS DATE) AS date,
           CASE o_orderstatus WHEN 'F' THEN 'constant_maturity' WHEN 'O' THEN 'zero_coupon'
                ELSE 'instantaneous_forward' END AS component,
           {_TENOR_SQL} AS tenor, max(round(o_totalprice * 100)) AS value
    FROM orders GROUP BY ALL"""
_COMPONENTS = ("constant_maturity", "zero_coupon", "instantaneous_forward")
_WIDE_NAMES = [(c, t, K.CURVE_PREFIXES[c] + t) for c in _COMPONENTS for t in K.CURVES[c]]


@query("full_curve", f"""
    WITH rows AS ({_CURVE_SQL})
    SELECT CAST(date AS VARCHAR) AS date, {', '.join(
        f'''max(CASE WHEN component = '{c}' AND tenor = '{t}' THEN value END) AS "{name}"'''
        for c, t, name in _WIDE_NAMES)}
    FROM rows GROUP BY 1""")
def _full_curve(spark, sf):
    return shown(full_curve(curve_rows(spark, sf)))


@query("full_curve_long", f"""
    WITH rows AS ({_CURVE_SQL}),
    grid AS (SELECT DISTINCT date FROM rows),
    names AS (SELECT * FROM (VALUES {', '.join(f"('{c}', '{t}', '{n}')" for c, t, n in _WIDE_NAMES)})
              AS v(component, tenor, name))
    SELECT CAST(grid.date AS VARCHAR) AS date, name AS tenor, value
    FROM grid CROSS JOIN names
    LEFT JOIN rows ON rows.date = grid.date AND rows.component = names.component
                  AND rows.tenor = names.tenor""")
def _full_curve_long(spark, sf):
    return shown(full_curve(curve_rows(spark, sf), long_format=True))


@query("single_curve", f"""
    WITH rows AS ({_CURVE_SQL})
    SELECT CAST(date AS VARCHAR) AS date, max(CASE WHEN tenor = '2Y' THEN value END) AS "2Y",
           max(CASE WHEN tenor = '5Y' THEN value END) AS "5Y"
    FROM rows WHERE component = 'zero_coupon' AND tenor IN ('2Y', '5Y') GROUP BY 1""")
def _single_curve(spark, sf):
    return shown(single_curve(curve_rows(spark, sf), "zero_coupon", ["5Y", "2Y"]))


@query("periods_to_long", """
    WITH wide AS (SELECT l_returnflag AS unit, l_linestatus AS freq, l_quantity AS m, l_tax AS t,
                         l_linenumber AS line FROM lineitem)
    SELECT unit, freq, date, 'check' AS indicator, CAST(sum(value) AS DOUBLE) AS total, count(*) AS n
    FROM (SELECT unit, freq, '2024-02-01' AS date, m AS value FROM wide
          UNION ALL SELECT unit, freq, '2024-04-01', line FROM wide WHERE t <> 0
          UNION ALL SELECT unit, freq, '2024-07-01', line FROM wide
          UNION ALL SELECT unit, freq, '2023-01-01', m + line FROM wide)
    GROUP BY ALL""")
def _periods_to_long(spark, sf):
    line = F.col("l_linenumber")
    wide = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("unit"),
        F.col("l_linestatus").alias("freq"),
        F.col("l_quantity").alias("2024-02"),
        F.when(F.col("l_tax") != 0, line.cast("string")).otherwise(F.lit(":")).alias("2024Q2"),
        line.alias("2024-Q3"),
        (F.col("l_quantity") + line).alias("2023"),
    )
    long = periods_to_long(wide, "check", BATCH_TS)
    return shown(
        long.groupBy("unit", "freq", "date", "indicator").agg(
            F.sum("value").alias("total"), F.count(F.lit(1)).alias("n")
        )
    )


@query("chains_to_long", """
    WITH side AS (
      SELECT CASE l_linestatus WHEN 'O' THEN 'call' ELSE 'put' END AS type,
             upper('sup' || l_suppkey) AS underlying, CAST(l_shipdate AS DATE) AS expiry,
             round(l_extendedprice * 100) / 100 AS strike, l_quantity AS volume,
             CASE WHEN l_linestatus = 'O' THEN l_tax <> 0 END AS itm
      FROM lineitem)
    SELECT type, underlying, CAST(max(expiry) AS VARCHAR) AS last_expiry, max(strike) AS top_strike,
           CAST(sum(volume) AS BIGINT) AS volume, count(itm) AS flagged,
           count(CASE WHEN itm THEN 1 END) AS in_the_money, count(*) AS contracts,
           '2024-06-01' AS snapshot_date
    FROM side GROUP BY type, underlying""")
def _chains_to_long(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.concat(F.lit("sup"), F.col("l_suppkey")).alias("underlying"),
        F.col("l_shipdate").cast("date").alias("expiry"),
        F.lit(220.5).alias("underlying_price"),
        F.lit(BATCH_TS).cast("timestamp").alias("snapshot_ts"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("contractSymbol"),
        F.col("l_extendedprice").alias("strike"),
        F.col("l_quantity").alias("volume"),
        F.col("l_tax").alias("inTheMoney"),
        "l_linestatus",
    )
    calls = lines.where("l_linestatus = 'O'").drop("l_linestatus")
    puts = lines.where("l_linestatus = 'F'").drop("l_linestatus", "inTheMoney")
    chain = chains_to_long(calls, puts)
    assert chain.columns == DATASETS["options"].schema.fieldNames()
    return shown(
        chain.groupBy("type", "underlying").agg(
            F.max("expiry").alias("last_expiry"),
            F.max("strike").alias("top_strike"),
            F.sum("volume").alias("volume"),
            F.count("in_the_money").alias("flagged"),
            F.count_if(F.col("in_the_money")).alias("in_the_money"),
            F.count(F.lit(1)).alias("contracts"),
            F.max("snapshot_date").alias("snapshot_date"),
        )
    )


@query("upsert", """
    WITH newest AS (
      SELECT l_orderkey AS k, max(round(l_extendedprice * 100)) AS price FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT coalesce(o_orderkey, -k) AS k, o_orderpriority AS label,
           coalesce(price, round(o_totalprice * 100)) AS price
    FROM orders LEFT JOIN newest ON k = o_orderkey
    UNION ALL
    SELECT -1 - k, NULL, price FROM newest""")
def _upsert(spark, sf):
    # Known keys get a new price and keep their label; negative keys are new.
    existing = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderpriority").alias("label"),
        cents("o_totalprice").alias("price"),
    )
    best = (
        table(spark, sf, "lineitem")
        .where("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(F.max(cents("l_extendedprice")).alias("price"))
    )
    known = best.join(existing.select("k"), "k", "left_semi")
    fresh = best.withColumn("k", -1 - F.col("k"))
    return upsert(existing, known.unionByName(fresh), ["k"])
