"""Rollups follow the buckets of their base that changed, and no others."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, ts
from tidemark.catalog import TABLES
from tidemark.operators.aggregate import ROLLUPS, roll_up
from tidemark.plans import load, rollup, upkeep
from tidemark.plans.invalidation import changed_buckets, overlapping
from tidemark.sinks import PublishedTable

BARS, NAME = "market_data_daily", "ohlcv_monthly"


def bars(spark, factors: dict[int, float] | None = None, months=range(1, 7)):
    """Two tickers, two days a month in 2024; ``factors`` multiply the prices of a month."""
    factors = factors or {}
    rows = [
        (t, day(f"2024-{m:02d}-{d:02d}"), factors.get(m, 1.0) * (m * 100 + d), ts("2024-07-01"))
        for t in "AB" for m in months for d in (3, 17)
    ]
    df = spark.createDataFrame(rows, "ticker STRING, date DATE, close DOUBLE, last_fetched_at TIMESTAMP")
    return df.withColumns({**{c: F.col("close") for c in ("open", "high", "low", "vwap")}, "volume": F.lit(1.0)})


def base_of(spark, store, name=BARS):
    return PublishedTable(spark, store, TABLES[name].dataset())


def rolled(spark, store):
    return {(r["bucket"], r["ticker"]): r["close"] for r in rollup.read_rollup(spark, store, NAME).collect()}


def version(spark, store, name=NAME):
    return PublishedTable(spark, store, rollup.rollup_dataset(ROLLUPS[name], TABLES[BARS].schema)).manifest().version


@pytest.fixture
def built(spark, store):
    load.load_table(spark, store, BARS, bars(spark))
    rollup.build_rollup(spark, store, NAME)
    return store


def test_overlap_of_widths():
    assert overlapping("year", day("2024-01-01"), "quarter") == {dt.date(2024, m, 1) for m in (1, 4, 7, 10)}
    assert overlapping("month", day("2024-12-01"), "month") == {day("2024-12-01")}
    assert overlapping("month", day("2024-05-01"), "quarter") == {day("2024-04-01")}
    assert len(overlapping("month", day("2024-02-01"), "day")) == 29


def test_equal_loads_change_nothing(spark, built):
    before = base_of(spark, built).manifest()
    load.load_table(spark, built, BARS, bars(spark).orderBy(F.desc("date")))
    after = base_of(spark, built).manifest()
    assert after.version == before.version + 1 and after.buckets == before.buckets
    assert rollup.refresh_changed(spark, built, NAME, day("2024-06-20")) == []
    assert version(spark, built) == 1


def test_only_changed_buckets_of_the_window_are_redone(spark, built):
    old = rolled(spark, built)
    load.load_table(spark, built, BARS, bars(spark, {1: 2.0, 4: 2.0, 6: 2.0}))
    base = base_of(spark, built)
    assert {n[-10:] for n in changed_buckets(base, 1, base.manifest())} == {f"2024-{m:02d}-01" for m in (1, 4, 6)}
    assert rollup.refresh_changed(spark, built, NAME, day("2024-06-20")) == [day("2024-04-01")]
    now = rolled(spark, built)
    assert {k for k in now if now[k] != old[k]} == {(day("2024-04-01"), t) for t in "AB"}
    # June was left for later; January stays behind its window for good.
    assert rollup.refresh_changed(spark, built, NAME, day("2024-06-20")) == []
    assert rollup.refresh_changed(spark, built, NAME, day("2024-07-20")) == [day("2024-06-01")]
    assert rollup.refresh_changed(spark, built, NAME, day("2024-07-20")) == []
    full = {(r["bucket"], r["ticker"]): r["close"] for r in roll_up(base.read(), ROLLUPS[NAME]).collect()}
    now = rolled(spark, built)
    assert {k[0] for k in now if now[k] != full[k]} == {day("2024-01-01")}


def test_only_files_of_changed_buckets_are_read(spark, built, monkeypatch):
    read = []
    monkeypatch.setattr(rollup, "roll_up", lambda df, r: read.extend(df.inputFiles()) or roll_up(df, r))
    load.load_table(spark, built, BARS, bars(spark, {4: 2.0}))
    rollup.refresh_changed(spark, built, NAME, day("2024-06-20"))
    assert read and all("2024-04-01" in f for f in read)


def test_new_and_lost_buckets_count_as_changed(spark, built):
    load.load_table(spark, built, BARS, bars(spark, months=(1, 2, 3, 5, 6, 7)))
    assert rollup.refresh_changed(spark, built, NAME, day("2024-06-20")) == [day("2024-04-01")]
    assert day("2024-04-01") not in {k[0] for k in rolled(spark, built)}
    assert rollup.refresh_changed(spark, built, NAME, day("2024-08-20")) == [day("2024-07-01")]


def test_compaction_is_no_change_and_survives_an_equal_load(spark, built):
    base = base_of(spark, built)
    assert upkeep.compact(base, day("2024-06-01"), ("ticker",))
    assert rollup.refresh_changed(spark, built, NAME, day("2024-06-20")) == []
    load.load_table(spark, built, BARS, bars(spark))
    assert sum(b["compacted"] for b in base.manifest().buckets.values()) == 5
    assert rollup.refresh_changed(spark, built, NAME, day("2024-06-20")) == []
    load.load_table(spark, built, BARS, bars(spark, {5: 3.0}))
    assert upkeep.compact(base, day("2024-06-01"), ("ticker",)) == ["2024-05-01"]
    assert rollup.refresh_changed(spark, built, NAME, day("2024-06-20")) == [day("2024-05-01")]


def test_a_rollup_without_a_note_is_behind_everywhere(spark, store):
    load.load_table(spark, store, BARS, bars(spark))
    assert rollup.refresh_changed(spark, store, NAME, day("2024-06-20")) == [day("2024-04-01"), day("2024-05-01")]
    assert rollup.refresh_changed(spark, store, NAME, day("2024-05-20")) == [day("2024-03-01")]
    assert {k[0].month for k in rolled(spark, store)} == {3, 4, 5}


def test_a_full_refresh_clears_its_window(spark, built):
    load.load_table(spark, built, BARS, bars(spark, {4: 2.0, 5: 2.0, 6: 2.0}))
    assert rollup.refresh_rollup(spark, built, NAME, day("2024-06-20")) == 4
    assert rollup.refresh_changed(spark, built, NAME, day("2024-06-20")) == []
    assert rollup.refresh_changed(spark, built, NAME, day("2024-07-20")) == [day("2024-06-01")]


def test_wide_base_buckets_redo_all_they_hold(spark, store):
    def rows(value):
        return spark.createDataFrame(
            [(day(f"2024-{m:02d}-15"), value if m == 5 else 1.0, "s", "S", ts("2024-07-01")) for m in range(1, 7)],
            "date DATE, value DOUBLE, series_label STRING, series_id STRING, last_fetched_at TIMESTAMP",
        )

    load.load_table(spark, store, "ecb_hicp", rows(1.0))
    rollup.build_rollup(spark, store, "hicp_monthly")
    load.load_table(spark, store, "ecb_hicp", rows(9.0))
    done = {r["rollup"]: r["refreshed_buckets"] for r in rollup.refresh_all_changed(spark, store, day("2024-07-20")).collect()}
    assert done == {"hicp_monthly": 3}
    found = {r["bucket"].month: r["avg_value"] for r in rollup.read_rollup(spark, store, "hicp_monthly").collect()}
    assert found == {1: 1.0, 2: 1.0, 3: 1.0, 4: 1.0, 5: 9.0, 6: 1.0}
