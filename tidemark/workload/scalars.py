"""Scalar rules over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import functions as S
from tidemark.workload.registry import cents, query, shown, table


@query("parse_period", """
    WITH texts AS (
      SELECT o_orderdate AS d, CASE substr(o_orderpriority, 1, 1)
        WHEN '1' THEN strftime(o_orderdate, '%Y')
        WHEN '2' THEN strftime(o_orderdate, '%Y-%m')
        WHEN '3' THEN strftime(o_orderdate, '%Y') || 'Q' || quarter(o_orderdate)
        WHEN '4' THEN strftime(o_orderdate, '%Y') || '-Q' || quarter(o_orderdate)
        ELSE CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END END
        AS period FROM orders)
    SELECT period, CAST(min(CAST(CASE
        WHEN period = 'n/a' THEN NULL
        WHEN length(period) = 4 THEN date_trunc('year', d)
        WHEN period LIKE '%Q%' THEN date_trunc('quarter', d)
        WHEN length(period) = 7 THEN date_trunc('month', d) ELSE d END AS DATE)) AS VARCHAR) AS date,
      count(*) AS n
    FROM texts GROUP BY 1""")
def _parse_period(spark, sf):
    d = F.col("o_orderdate")
    kind = F.substring("o_orderpriority", 1, 1)
    year, quarter = F.date_format(d, "yyyy"), F.quarter(d).cast("string")
    period = (
        F.when(kind == "1", year)
        .when(kind == "2", F.date_format(d, "yyyy-MM"))
        .when(kind == "3", F.concat(year, F.lit("Q"), quarter))
        .when(kind == "4", F.concat(year, F.lit("-Q"), quarter))
        .when(F.col("o_orderstatus") == "P", F.lit("n/a"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    texts = table(spark, sf, "orders").select(period.alias("period"))
    parsed = texts.select("period", S.parse_period("period").alias("date"))
    return shown(parsed.groupBy("period", "date").agg(F.count(F.lit(1)).alias("n")))


@query("snake_case", """
    SELECT p_partkey,
           p_brand || '_' || upper(p_type) AS name,
           lower(p_brand) || '_' || lower(p_type) AS snake,
           lower(regexp_replace(p_type || 'EPSValue' || p_brand, '([a-z])([A-Z])', '\\1_\\2', 'g'))
             AS snake_mixed
    FROM part""")
def _snake_case(spark, sf):
    name = F.concat("p_brand", F.lit("_"), F.upper("p_type"))
    mixed = F.concat("p_type", F.lit("EPSValue"), "p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        name.alias("name"),
        S.snake_case(name).alias("snake"),
        S.snake_case(mixed).alias("snake_mixed"),
    )


@query("to_decimal6", """
    WITH v AS (SELECT l_orderkey AS k, l_linenumber AS line,
                      CAST(round(l_extendedprice * 100) AS HUGEINT) * 1000000000
                        + CAST(round(l_tax * 100) AS HUGEINT) * 50 + 25 AS e11 FROM lineitem),
    parts AS (SELECT *, e11 // 100000 AS whole, e11 % 100000 AS rest FROM v)
    SELECT k, line,
           CAST(whole + CASE WHEN rest > 50000 OR (rest = 50000 AND whole % 2 = 1) THEN 1 ELSE 0 END
                AS DOUBLE) / 1e6 AS amount,
           count(*) AS n
    FROM parts GROUP BY ALL""")
def _to_decimal6(spark, sf):
    # Eleven decimals, so that the sixth has to be rounded, half to even.
    digits = (
        (cents("l_extendedprice").cast("decimal(28,0)") * F.lit(1_000_000_000))
        + cents("l_tax").cast("decimal(28,0)") * 50
        + 25
    )
    text = (digits.cast("decimal(30,0)") / F.lit(10**11).cast("decimal(12,0)")).cast("decimal(38,11)")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("line"),
        S.to_decimal6(text.cast("string")).alias("amount"),
    )
    return shown(rows.groupBy("k", "line", "amount").agg(F.count(F.lit(1)).alias("n")))


@query("null_tokens", """
    SELECT o_orderpriority AS p,
           count(*) AS n,
           count(CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS numbers,
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS DOUBLE) AS total,
           count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS texts
    FROM orders GROUP BY 1""")
def _null_tokens(spark, sf):
    # Open orders carry a number, finished ones a "no value" token, pending ones other text.
    token = F.element_at(
        F.array(*[F.lit(t) for t in ("None", "", "null", "NULL")]),
        F.pmod(F.col("o_custkey"), F.lit(4)).cast("int") + 1,
    )
    text = (
        F.when(F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string"))
        .when(F.col("o_orderstatus") == "F", token)
        .otherwise(F.lit("12d"))
    )
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p"), text.alias("text"))
    number, kept = S.null_token_number("text"), S.null_token_text("text")
    return rows.groupBy("p").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(number).alias("numbers"),
        F.sum(number).alias("total"),
        F.count_if(kept.isNotNull() & number.isNull()).alias("texts"),
    )


@query("number_rules", """
    SELECT l_returnflag AS flag, l_linestatus AS status,
           count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS dotted,
           CAST(sum(CASE WHEN l_returnflag <> 'A' THEN l_quantity END) AS DOUBLE) AS dot_total,
           CAST(sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) AS DOUBLE) AS lenient_total,
           CAST(sum(CAST(trunc(l_extendedprice / 7) AS BIGINT)) AS BIGINT) AS long_total,
           count(CASE WHEN l_tax <> 0 THEN 1 END) AS taxed
    FROM lineitem GROUP BY 1, 2""")
def _number_rules(spark, sf):
    quantity = F.col("l_quantity").cast("string")
    dotted = F.when(F.col("l_returnflag") == "A", F.lit(".")).otherwise(quantity)
    dirty = F.when(F.col("l_returnflag") == "N", F.lit("n/a")).otherwise(quantity)
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")
    ).agg(
        F.count_if(S.dot_to_null(dotted).isNull()).alias("dotted"),
        F.sum(S.dot_to_null(dotted)).alias("dot_total"),
        F.sum(S.lenient_number(dirty)).alias("lenient_total"),
        F.sum(S.to_long(F.col("l_extendedprice") / 7)).alias("long_total"),
        F.count_if(S.to_bool("l_tax")).alias("taxed"),
    )


@query("date_rules", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
           CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month_start,
           strftime(CAST(ts AS DATE) - 7, '%Y-%m-%d') AS week_before,
           strftime(ts, '%Y-%m') AS month_text, count(*) AS n
    FROM events GROUP BY ALL""")
def _date_rules(spark, sf):
    # Through epoch milliseconds, day text and timestamp: all must agree.
    micros = F.unix_micros(S.as_utc("ts"))
    rows = table(spark, sf, "events").select(
        S.ms_to_date(F.floor(micros / 1000)).alias("day"),
        S.utc_date(S.as_utc("ts")).alias("snapshot_date"),
    )
    agreed = rows.where(
        (F.col("day") == F.col("snapshot_date"))
        & (S.strict_date(S.day_text("day")) == F.col("day"))
        & (S.lenient_date(S.day_text("day")) == F.col("day"))
    )
    return shown(
        agreed.groupBy(
            "day",
            S.month_start("day").alias("month_start"),
            S.day_text(S.days_before("day", 7)).alias("week_before"),
            S.month_text("day").alias("month_text"),
        ).agg(F.count(F.lit(1)).alias("n"))
    )


@query("text_rules", """
    SELECT doc_id, length(text) AS characters, upper(lang) AS lang_key,
           replace(lower(source), ' ', '_') AS label
    FROM documents""")
def _text_rules(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        S.characters("text").alias("characters"),
        S.upper_key("lang").alias("lang_key"),
        S.series_label(F.concat(F.lit("5. "), F.lower("source"))).alias("label"),
    ).withColumn("characters", F.col("characters").cast("bigint"))


@query("first_available", """
    SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_retailprice END, p_size * 1.0) AS price
    FROM part""")
def _first_available(spark, sf):
    quick = F.when(F.col("p_size") > 25, F.col("p_retailprice"))
    return table(spark, sf, "part").select(
        "p_partkey", S.first_available(quick, F.col("p_size").cast("double")).alias("price")
    )
