"""Merge, union, reshape, gates and profiles on small frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import day, ts
from tidemark import constants as K
from tidemark.catalog import DATASETS, OPTIONS_GATE, Gate
from tidemark.operators.aggregate import ohlcv
from tidemark.operators.limits import paged_limit, sample
from tidemark.operators.merge import dedupe_grain, merge_latest, upsert
from tidemark.operators.profile import column_stats, null_profile, numeric_summary
from tidemark.operators.project import (
    between_dates,
    incremental_since,
    incremental_start,
    select_series,
)
from tidemark.operators.quality import GateError, enforce, gate_report
from tidemark.operators.reshape import (
    UnmappedSeries,
    curve_to_long,
    curve_wide,
    fill_failed_series,
    full_curve,
    map_series_id,
    merge_series,
    periods_to_long,
)
from tidemark.operators.union import relaxed_union, supertype

SERIES = "date DATE, value DOUBLE, last_fetched_at TIMESTAMP"
BATCH = "2024-06-01 00:00:00"


def series(spark, *rows):
    return spark.createDataFrame([(day(d), v, f and ts(f)) for d, v, f in rows], SERIES)


def values(df, column="value", *order):
    return [r[column] for r in df.orderBy(*(order or ("date",))).collect()]


# -- merge --------------------------------------------------------------------


def test_merge_without_overlap(spark):
    old = series(spark, ("2024-01-01", 1.0, "2024-01-01"), ("2024-01-02", 2.0, "2024-01-01"))
    new = series(spark, ("2024-01-03", 3.0, "2024-01-02"), ("2024-01-04", 4.0, "2024-01-02"))
    assert values(merge_latest(old, new, ["date"])) == [1.0, 2.0, 3.0, 4.0]


def test_merge_keeps_newest_fetch(spark):
    old = series(spark, ("2024-01-01", 1.0, "2024-01-01"))
    new = series(spark, ("2024-01-01", 2.0, "2024-01-02"))
    assert values(merge_latest(old, new, ["date"])) == [2.0]
    assert values(merge_latest(new, old, ["date"])) == [2.0]


def test_merge_into_empty(spark):
    new = series(spark, ("2024-01-01", 1.0, "2024-01-01"))
    assert values(merge_latest(new.limit(0), new, ["date"])) == [1.0]


def test_merge_tie_goes_to_new_batch_and_null_fetch_loses(spark):
    old = series(spark, ("2024-01-01", 1.0, "2024-01-05"), ("2024-01-02", 1.0, "2024-01-05"))
    new = series(spark, ("2024-01-01", 2.0, "2024-01-05"), ("2024-01-02", 2.0, None))
    assert values(merge_latest(old, new, ["date"])) == [2.0, 1.0]


def test_merge_is_idempotent_and_independent_of_split_and_partitions(spark):
    rows = [(f"2024-01-{1 + i % 9:02d}", float(i), f"2024-02-{1 + i % 20:02d}") for i in range(60)]
    whole = series(spark, *rows)
    empty = whole.limit(0)
    once = merge_latest(empty, whole, ["date"])
    first, second = series(spark, *rows[:23]), series(spark, *rows[23:])
    for other in (
        merge_latest(once, whole, ["date"]),
        merge_latest(merge_latest(empty, first, ["date"]), second, ["date"]),
        merge_latest(empty, whole.repartition(1), ["date"]),
        merge_latest(empty, whole.repartition(8), ["date"]),
    ):
        assert sorted(other.collect()) == sorted(once.collect())


def test_ties_of_a_batch_do_not_depend_on_what_is_stored(spark):
    rows = [(f"2024-01-{1 + i % 9:02d}", float(i), "2024-02-01") for i in range(90)]
    new = series(spark, *rows)
    alone = sorted(dedupe_grain(new, ["date"]).collect())
    wider = series(spark, ("2024-01-01", -1.0, "2024-01-01")).withColumn("note", F.lit("x"))
    for old in (series(spark).limit(0), wider):
        merged = merge_latest(old, new, ["date"]).select(*new.columns)
        assert sorted(merged.collect()) == alone


def test_merge_cuts_hot_keys_before_the_shuffle(spark):
    # Two thirds of the rows share one key.
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"),
        F.col("id").cast("double").alias("value"),
        F.timestamp_seconds("id").alias("last_fetched_at"),
    )
    newest = dedupe_grain(hot, ["k"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert newest.where("k = -1").first()["value"] == 2999.0
    assert newest.count() == 1001


def test_merge_handles_map_columns(spark):
    schema = "k INT, extra MAP<STRING,STRING>, last_fetched_at TIMESTAMP"
    old = spark.createDataFrame([(1, {"a": "1"}, ts("2024-01-01"))], schema)
    new = spark.createDataFrame([(1, {"a": "2"}, ts("2024-01-01"))], schema)
    assert merge_latest(old, new, ["k"]).first()["extra"] == {"a": "2"}


def test_upsert_keeps_columns_the_batch_does_not_carry(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k INT, label STRING, value DOUBLE")
    new = spark.createDataFrame([(2, 9.0), (3, 3.0)], "k INT, value DOUBLE")
    got = sorted(tuple(r) for r in upsert(old, new, ["k"]).collect())
    assert got == [(1, "a", 1.0), (2, "b", 9.0), (3, None, 3.0)]


def test_upsert_all_columns_and_keys_only(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k INT, value DOUBLE")
    new = spark.createDataFrame([(2, None), (3, 3.0)], "k INT, value DOUBLE")
    assert sorted(tuple(r) for r in upsert(old, new, ["k"]).collect()) == [(1, 1.0), (2, None), (3, 3.0)]
    keys = spark.createDataFrame([(2,), (4,)], "k INT")
    got = {r["k"]: r["value"] for r in upsert(old, keys, ["k"]).collect()}
    assert got == {1: 1.0, 2: 2.0, 4: None}


# -- union --------------------------------------------------------------------


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.LongType(), T.DoubleType(), T.DoubleType()),
        (T.DoubleType(), T.StringType(), T.StringType()),
        (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.DecimalType(18, 6), T.DoubleType(), T.DoubleType()),
        (T.DecimalType(18, 6), T.LongType(), T.DecimalType(26, 6)),
        (T.BooleanType(), T.LongType(), T.LongType()),
        (T.NullType(), T.DateType(), T.DateType()),
    ],
)
def test_supertype_is_symmetric(a, b, want):
    assert supertype(a, b) == want
    assert supertype(b, a) == want


def test_union_of_number_and_bad_text_keeps_both(spark):
    # A plain union would cast the text to double and fail.
    left = spark.createDataFrame([(1.5,)], "v DOUBLE")
    right = spark.createDataFrame([("n/a", 1)], "v STRING, w INT")
    got = sorted(tuple(r) for r in relaxed_union(left, right).collect())
    assert got == [("1.5", None), ("n/a", 1)]


# -- projection ---------------------------------------------------------------


def test_incremental_start(spark):
    stored = spark.createDataFrame([(day("2024-01-10"),), (day("2024-01-15"),)], "date DATE")
    assert incremental_start(stored, 7).first()[0] == day("2024-01-08")
    assert incremental_start(stored, 7, monthly=True).first()[0] == day("2024-01-01")
    assert incremental_start(stored.limit(0), 7).first()[0] is None
    new = spark.createDataFrame([(day("2024-01-07"),), (day("2024-01-08"),)], "date DATE")
    assert incremental_since(stored, new, 7).count() == 1
    assert incremental_since(stored.limit(0), new, 7).count() == 2


def test_between_dates_bounds_are_inclusive_and_optional(sample_df):
    assert between_dates(sample_df).count() == 3
    assert between_dates(sample_df, start="2024-01-02").count() == 2
    assert between_dates(sample_df, "2024-01-02", "2024-01-02").count() == 1


def test_select_series(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "s STRING")
    assert select_series(df, "ALL", "s").count() == 3
    assert select_series(df, "a", "s", ["a", "b"]).count() == 1
    with pytest.raises(KeyError):
        select_series(df, ["a", "x"], "s", ["a", "b"])


def test_paged_limit():
    assert [paged_limit(n) for n in (1, 500, 501, 2500)] == [500, 500, 1000, 2500]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = sample(df.repartition(1), 20, 3, "k").collect()
    assert a == sample(df.repartition(7), 20, 3, "k").collect()
    assert len(a) == 20
    assert a != sample(df, 20, 4, "k").collect()
    assert sample(df.limit(5), 20, 3, "k").count() == 5


# -- reshape ------------------------------------------------------------------


def test_curve_to_long_keeps_missing_values(spark):
    wide = spark.createDataFrame(
        [(day("2024-01-01"), 1.0, None), (day("2024-01-02"), None, 2.0)],
        "date DATE, `1M` DOUBLE, `10Y` DOUBLE",
    )
    long = curve_to_long(wide, K.CONSTANT_MATURITY, "constant_maturity", BATCH)
    assert long.count() == 4
    assert long.where("value IS NULL").count() == 2
    row = long.where("tenor = '10Y' AND value IS NOT NULL").first()
    assert (row["fred_series_id"], row["component"], row["source"]) == ("DGS10", "constant_maturity", "FRED")
    assert curve_wide(long, ["1M", "10Y"]).orderBy("date").collect() == wide.orderBy("date").collect()
    # Tenors sort as text.
    assert [r["tenor"] for r in long.select("tenor").distinct().orderBy("tenor").collect()] == ["10Y", "1M"]


def test_curve_to_long_without_series_is_typed_and_empty(spark):
    wide = spark.createDataFrame([(day("2024-01-01"),)], "date DATE")
    long = curve_to_long(wide, K.CONSTANT_MATURITY, "constant_maturity", BATCH)
    assert long.count() == 0
    assert long.schema == DATASETS["treasury_constant_maturity"].schema


def test_unmapped_series_is_an_error(spark):
    wide = spark.createDataFrame([(day("2024-01-01"), 1.0)], "date DATE, `99Y` DOUBLE")
    with pytest.raises(UnmappedSeries):
        curve_to_long(wide, K.CONSTANT_MATURITY, "constant_maturity", BATCH)
    with pytest.raises(Exception, match="no series id for 99Y"):
        map_series_id(spark.createDataFrame([("99Y",)], "tenor STRING"), K.CONSTANT_MATURITY).collect()


def test_merge_series_outer_joins_on_date(spark):
    a = spark.createDataFrame([(day("2024-01-01"), 1.0), (day("2024-01-02"), 2.0)], "date DATE, `1M` DOUBLE")
    b = spark.createDataFrame([(day("2024-01-02"), 3.0), (day("2024-01-03"), 4.0)], "date DATE, `3M` DOUBLE")
    wide = merge_series([a, b], ["1M", "3M"]).orderBy("date")
    assert [tuple(r)[1:] for r in wide.collect()] == [(1.0, None), (2.0, 3.0), (None, 4.0)]
    filled = fill_failed_series(wide, ["6M", "1M"])
    assert filled.columns == ["date", "1M", "3M", "6M"]
    assert filled.where("`6M` IS NOT NULL").count() == 0


def test_repeated_date_in_a_series_does_not_multiply_rows(spark):
    rows = [("a", day("2024-01-01"), 1.0, ts("2024-01-02")), ("a", day("2024-01-01"), 2.0, ts("2024-01-03"))]
    long = spark.createDataFrame(rows, "tenor STRING, date DATE, value DOUBLE, f TIMESTAMP")
    assert [tuple(r) for r in curve_wide(long, ["a"], newest_by="f").collect()] == [(day("2024-01-01"), 2.0)]


def test_full_curve_tells_spot_and_forward_premiums_apart(spark):
    rows = [
        (day("2024-01-01"), "5Y", 1.0, "term_premium_spot"),
        (day("2024-01-01"), "5Y", 2.0, "term_premium_forward"),
    ]
    long = spark.createDataFrame(rows, "date DATE, tenor STRING, value DOUBLE, component STRING")
    wide = full_curve(long, ["term_premium_spot", "term_premium_forward"])
    row = wide.first()
    assert (row["TP_5Y"], row["TPFWD_5Y"]) == (1.0, 2.0)
    assert len(wide.columns) == 21
    grid = full_curve(long, ["term_premium_spot"], long_format=True)
    assert grid.count() == 10


def test_periods_to_long_reads_every_period_spelling(spark):
    wide = spark.createDataFrame(
        [("M", "DE", "1.5", ":", 3.0, float("nan"), "x")],
        "freq STRING, `geo\\TIME_PERIOD` STRING, `2024-01` STRING, `2024Q2` STRING, "
        "`2024-Q3` DOUBLE, `2023` DOUBLE, unit STRING",
    )
    long = periods_to_long(wide, "gdp", BATCH, {"country": F.col("`geo\\TIME_PERIOD`")})
    got = {(r["date"], r["value"]) for r in long.collect()}
    assert got == {(day("2024-01-01"), 1.5), (day("2024-07-01"), 3.0)}
    row = long.first()
    assert (row["country"], row["unit"], row["indicator"], row["source"]) == ("DE", "x", "gdp", "EUROSTAT")


def test_periods_to_long_without_periods_is_empty(spark):
    wide = spark.createDataFrame([("M",)], "freq STRING")
    assert periods_to_long(wide, "x", BATCH).count() == 0


# -- rollups ------------------------------------------------------------------


def test_first_and_last_keep_null(spark):
    rows = [
        ("A", day("2024-01-02"), None, 5.0),
        ("A", day("2024-01-03"), 2.0, 6.0),
        ("A", day("2024-01-31"), 3.0, None),
    ]
    bars = spark.createDataFrame(rows, "ticker STRING, date DATE, open DOUBLE, close DOUBLE").withColumns(
        {c: F.lit(1.0) for c in ("high", "low", "volume", "vwap")}
    )
    row = ohlcv(bars).first()
    assert (row["open"], row["close"], row["trading_days"]) == (None, None, 3)


def test_rollup_aggregates_before_the_shuffle(spark):
    bars = spark.createDataFrame([], DATASETS["daily_bars"].schema)
    plan = ohlcv(bars.withColumn("ticker", F.lit("A")))._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan


# -- gates --------------------------------------------------------------------


def test_gates(spark, sample_df):
    enforce(sample_df, Gate())
    for gate, message in [
        (Gate(required=("date", "x"), not_all_null=()), "required_columns"),
        (Gate(max_rows=2), "row_count"),
        (Gate(min_date="2024-01-05"), "min_date"),
        (Gate(max_date="2024-01-02"), "max_date"),
        (Gate(min_rows=4), "row_count"),
        (Gate(date_column="day", required=()), "date_column"),
    ]:
        with pytest.raises(GateError, match=message):
            enforce(sample_df, gate)
    with pytest.raises(GateError, match="not_empty"):
        enforce(sample_df.limit(0), Gate(max_rows=0))
    hollow = spark.createDataFrame([(None, 1.0), (None, 2.0)], "date DATE, value DOUBLE")
    with pytest.raises(GateError, match="all null: date"):
        enforce(hollow, Gate())


def test_first_failure_follows_the_check_order(sample_df):
    with pytest.raises(GateError, match="row_count") as caught:
        enforce(sample_df, Gate(required=("x",), max_rows=1, min_date="2030-01-01"))
    assert list(caught.value.failures) == ["row_count"]


def test_gate_bounds_ignore_missing_dates(spark):
    hollow = spark.createDataFrame([(None, 1.0)], "date DATE, value DOUBLE")
    report = gate_report(hollow, Gate(not_all_null=(), min_date="2024-01-01"))
    assert all(r["ok"] for r in report.collect())


def test_options_gate_wants_every_key_column(spark):
    rows = spark.createDataFrame([("A", "call")], "underlying STRING, type STRING")
    with pytest.raises(GateError, match="required_columns"):
        enforce(rows, OPTIONS_GATE)


# -- profile ------------------------------------------------------------------


def test_profile_of_an_empty_dataset(spark):
    empty = spark.createDataFrame([], "a INT, b STRING")
    assert [r["null_percent"] for r in null_profile(empty).collect()] == [0.0, 0.0]
    assert {r["uniques"] for r in column_stats(empty).collect()} == {0}


def test_null_counts_as_one_unique_value(spark):
    df = spark.createDataFrame([(1, True, "é"), (1, False, None), (None, None, "abc")], "a INT, f BOOLEAN, s STRING")
    stats = {r["column"]: r for r in column_stats(df).collect()}
    assert [stats[c]["uniques"] for c in "afs"] == [2, 3, 3]
    assert stats["f"]["mean_number"] == 50.0
    assert (stats["s"]["min_number"], stats["s"]["max_number"]) == (1.0, 3.0)
    assert {r["column"]: r["uniques"] for r in column_stats(df, approximate=True).collect()} == {"a": 2, "f": 3, "s": 3}


def test_single_row_has_no_deviation(spark):
    assert numeric_summary(spark.createDataFrame([(2.0,)], "a DOUBLE")).first()["std"] is None


def test_summary_without_numeric_columns_is_empty(spark):
    assert numeric_summary(spark.createDataFrame([("x",)], "a STRING")).count() == 0


def test_nested_columns_are_profiled(spark):
    df = spark.createDataFrame([({"a": "1"}, [1]), ({"a": "1"}, [2])], "m MAP<STRING,STRING>, l ARRAY<INT>")
    assert {r["column"]: r["uniques"] for r in column_stats(df).collect()} == {"m": 1, "l": 2}


def test_an_empty_table_has_the_schema_asked_for(spark):
    from tidemark.operators.project import empty_like

    for dataset in DATASETS.values():
        empty = empty_like(spark, dataset.schema)
        assert empty.schema == dataset.schema and empty.isEmpty()
