"""Scalar rules, one value at a time."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import day
from tidemark import functions as S


def apply(spark, rule, values, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[1] for r in rows.select("i", rule("v").alias("x")).orderBy("i").collect()]


def test_parse_period(spark):
    texts = ["2024", "2024-03", "2024Q2", "2024-Q4", "2024-03-15", "2024-13", "2024Q5", "March", "", None, "2024-1"]
    want = [day("2024-01-01"), day("2024-03-01"), day("2024-04-01"), day("2024-10-01"), day("2024-03-15")]
    assert apply(spark, S.parse_period, texts, "STRING") == want + [None] * 6


def test_period_names():
    yes = ["2024", "2024-01", "2024Q1", "2024-Q1"]
    no = ["freq", "2024-1", "2024Q5", "20245", "geo\\TIME_PERIOD", "2024-01-01"]
    assert all(S.looks_like_period(n) for n in yes)
    assert not any(S.looks_like_period(n) for n in no)


def test_dates(spark):
    texts = ["2024-02-29", "2023-02-29", "2024-1-1", "x", None]
    assert apply(spark, S.lenient_date, texts, "STRING") == [day("2024-02-29"), None, None, None, None]
    with pytest.raises(Exception):
        apply(spark, S.strict_date, ["x"], "STRING")
    millis = [0, 1704067200000, 1704067199999, -1]
    want = [day("1970-01-01"), day("2024-01-01"), day("2023-12-31"), day("1969-12-31")]
    assert apply(spark, S.ms_to_date, millis, "BIGINT") == want


def test_utc_date_ignores_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 01:00:00' AS n, 1704067200000 AS ms")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(
            S.utc_date(S.as_utc("n")).alias("d"), S.ms_to_date("ms").alias("m")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["d"] == row["m"] == day("2024-01-01")


def test_numbers(spark):
    assert apply(spark, S.dot_to_null, [".", "4.5", None], "STRING") == [None, 4.5, None]
    with pytest.raises(Exception):
        apply(spark, S.dot_to_null, ["x"], "STRING")
    texts = ["1.5", " 2 ", "1d", "2.F", "nan", "x", "", None, "1e3"]
    assert apply(spark, S.lenient_number, texts, "STRING") == [1.5, 2.0, None, None, None, None, None, None, 1000.0]
    tokens = ["None", "", "null", "NULL", "7", "text"]
    assert apply(spark, S.null_token_number, tokens, "STRING") == [None] * 4 + [7.0, None]
    assert apply(spark, S.null_token_text, tokens, "STRING") == [None] * 4 + ["7", "text"]


def test_decimal_rounds_half_even(spark):
    texts = ["0.0000005", "0.0000015", "1.2345675", "-0.0000025", "nan", "x", None]
    want = [Decimal("0.000000"), Decimal("0.000002"), Decimal("1.234568"), Decimal("-0.000002"), None, None, None]
    assert apply(spark, S.to_decimal6, texts, "STRING") == want
    doubles = [220.5, float("inf"), float("nan"), 1e13]
    assert apply(spark, S.to_decimal6, doubles, "DOUBLE") == [Decimal("220.500000"), None, None, None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**14, 10**14), min_size=1, max_size=30))
def test_decimal_equals_quantize(spark, digits):
    texts = [str(Decimal(d).scaleb(-8)) for d in digits]
    want = [Decimal(t).quantize(Decimal("0.000001")) for t in texts]
    assert apply(spark, S.to_decimal6, texts, "STRING") == want


def test_long_and_bool(spark):
    assert apply(spark, S.to_long, [1.9, -1.9, float("nan"), None], "DOUBLE") == [1, -1, None, None]
    assert apply(spark, S.to_long, ["7", "7.5", "x"], "STRING") == [7, None, None]
    assert apply(spark, S.to_bool, [0.0, 2.0, None], "DOUBLE") == [False, True, None]


def test_names(spark):
    names = ["reportedEPS", "fiscalDateEnding", "EBITDA", "PERatio", "grossProfit", "52WeekHigh"]
    want = ["reported_eps", "fiscal_date_ending", "ebitda", "peratio", "gross_profit", "52week_high"]
    assert apply(spark, S.snake_case, names, "STRING") == want
    assert [S.snake_name(n) for n in names] == want
    labels = ["1. open", "5. adjusted close", "volume", "8. split. coefficient"]
    assert apply(spark, S.series_label, labels, "STRING") == ["open", "adjusted_close", "volume", "split._coefficient"]


def test_buckets(spark):
    days = [day("2024-02-29"), day("2024-12-31"), day("2024-01-01")]
    assert apply(spark, lambda c: S.time_bucket("quarter", c), days, "DATE") == [
        day("2024-01-01"), day("2024-10-01"), day("2024-01-01")
    ]
    assert apply(spark, lambda c: S.next_bucket("month", S.time_bucket("month", c)), days, "DATE") == [
        day("2024-03-01"), day("2025-01-01"), day("2024-02-01")
    ]


def test_percent_of_nothing_is_zero(spark):
    row = spark.range(1).select(S.percent(F.lit(1), F.lit(0)).alias("p"), S.percent(F.lit(1), F.lit(4)).alias("q")).first()
    assert tuple(row) == (0.0, 25.0)
