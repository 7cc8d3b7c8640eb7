"""Publishing, saving, loading, rolling up, upkeep, ledgers and streams."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, ts
from tidemark.catalog import DATASETS, TABLES, Dataset, Gate, table_schema
from tidemark.operators.aggregate import ROLLUPS, roll_up
from tidemark.operators.ledger import (
    append_state,
    failed_symbols,
    last_status,
    read_state,
    reset_state,
    run_report,
    task_report,
)
from tidemark.plans import load, rollup, save, upkeep
from tidemark.session import scratch_root
from tidemark.sinks import ConcurrentPublish, PublishedTable
from tidemark.plans.marks import read_marks
from tidemark.plans.outcomes import read_outcomes
from tidemark.sinks.published import bucket_value, read_lineage
from tidemark.streaming import landed_stream, merge_stream

PRICES = Dataset(
    "prices",
    table_schema("date DATE", "value DOUBLE", "last_fetched_at TIMESTAMP"),
    keys=("date",),
)
BARS = DATASETS["daily_bars"]


def prices(spark, *rows):
    return spark.createDataFrame(
        [(d and day(d), v, ts(f)) for d, v, f in rows], "date DATE, value DOUBLE, last_fetched_at TIMESTAMP"
    )


def bars(spark, *rows):
    """(ticker, date, close, fetched) to bars."""
    df = spark.createDataFrame(
        [(t, d and day(d), c, ts(f)) for t, d, c, f in rows],
        "ticker STRING, date DATE, close DOUBLE, last_fetched_at TIMESTAMP",
    )
    same = {c: F.col("close") for c in ("open", "high", "low", "vwap")}
    return df.withColumns({**same, "volume": F.lit(1.0), "transactions": F.lit(1), "source": F.lit("POLYGON")})


def stored(spark, store, dataset=PRICES):
    return {r["date"]: r["value"] for r in PublishedTable(spark, store, dataset).read().collect()}


# -- save ---------------------------------------------------------------------


def test_save_and_repeat(spark, store):
    batch = prices(spark, ("2024-01-01", 1.0, "2024-01-01"), ("2024-02-02", 2.0, "2024-01-01"))
    first = save.save_dataset(spark, store, PRICES, batch)
    again = save.save_dataset(spark, store, PRICES, batch)
    assert (first.status, first.version, first.rows) == ("saved", 1, 2)
    assert (again.status, again.version, again.rows) == ("saved", 2, 2)
    assert stored(spark, store) == {day("2024-01-01"): 1.0, day("2024-02-02"): 2.0}


def test_first_save_is_deduplicated(spark, store):
    batch = prices(spark, ("2024-01-01", 1.0, "2024-01-01"), ("2024-01-01", 2.0, "2024-01-02"))
    save.save_dataset(spark, store, PRICES, batch)
    assert stored(spark, store) == {day("2024-01-01"): 2.0}


def test_untouched_buckets_are_not_rewritten(spark, store):
    save.save_dataset(spark, store, PRICES, prices(spark, ("2024-01-01", 1.0, "2024-01-01"), ("2024-02-01", 1.0, "2024-01-01")))
    save.save_dataset(spark, store, PRICES, prices(spark, ("2024-02-01", 5.0, "2024-03-01")))
    buckets = PublishedTable(spark, store, PRICES).manifest().buckets
    before = PublishedTable(spark, store, PRICES).manifest(1).buckets
    assert buckets["__bucket=2024-01-01"] == before["__bucket=2024-01-01"]
    assert buckets["__bucket=2024-02-01"]["v"] != before["__bucket=2024-02-01"]["v"]
    assert stored(spark, store) == {day("2024-01-01"): 1.0, day("2024-02-01"): 5.0}


def test_nothing_new_writes_nothing(spark, store):
    batch = prices(spark, ("2024-01-01", 1.0, "2024-01-01"))
    assert save.save_dataset(spark, store, PRICES, batch.limit(0)).status == "skipped"
    assert not PublishedTable(spark, store, PRICES).exists()
    save.save_dataset(spark, store, PRICES, batch)
    assert save.save_dataset(spark, store, PRICES, batch.limit(0)).status == "skipped"
    assert PublishedTable(spark, store, PRICES).manifest().version == 1


def test_lookback(spark, store):
    save.save_dataset(spark, store, PRICES, prices(spark, ("2024-01-01", 1.0, "2024-01-01"), ("2024-01-20", 1.0, "2024-01-01")))
    batch = prices(spark, ("2024-01-01", 9.0, "2024-02-01"), ("2024-01-14", 9.0, "2024-02-01"))
    save.save_dataset(spark, store, PRICES, batch, lookback_days=7)
    assert stored(spark, store) == {day("2024-01-01"): 1.0, day("2024-01-14"): 9.0, day("2024-01-20"): 1.0}


def test_gate_blocks_the_whole_batch(spark, store):
    hollow = prices(spark, (None, 1.0, "2024-01-01"), (None, 2.0, "2024-01-01"))
    outcome = save.save_dataset(spark, store, PRICES, hollow)
    assert outcome.status == "failed" and "not_all_null" in outcome.reason
    assert not PublishedTable(spark, store, PRICES).exists()


def test_gate_looks_at_the_whole_table_not_only_at_the_batch(spark, store):
    save.save_dataset(spark, store, PRICES, prices(spark, ("2024-01-01", 1.0, "2024-01-01")))
    # Undated rows alone would fail, but the table has dates.
    assert save.save_dataset(spark, store, PRICES, prices(spark, (None, 1.0, "2024-01-01"))).status == "saved"
    bounded = replace(PRICES, gate=Gate(max_rows=2))
    outcome = save.save_dataset(spark, store, bounded, prices(spark, ("2024-03-01", 1.0, "2024-01-01")))
    assert outcome.status == "failed" and "row_count" in outcome.reason
    early = replace(PRICES, gate=Gate(min_date="2024-02-01"))
    outcome = save.save_dataset(spark, store, early, prices(spark, ("2024-03-01", 1.0, "2024-01-01")))
    assert outcome.status == "failed" and "min_date" in outcome.reason
    assert PublishedTable(spark, store, PRICES).manifest().rows == 2


def test_missing_key_column_fails(spark, store):
    outcome = save.save_dataset(spark, store, PRICES, prices(spark).drop("date"))
    assert outcome.status == "failed" and "date" in outcome.reason


def test_new_columns_and_wider_types_are_taken_in(spark, store):
    save.save_dataset(spark, store, PRICES, prices(spark, ("2024-01-01", 1.0, "2024-01-01")))
    later = prices(spark, ("2024-02-01", 2.0, "2024-02-01")).withColumn("note", F.lit("x"))
    save.save_dataset(spark, store, PRICES, later)
    rows = {r["date"]: r["note"] for r in PublishedTable(spark, store, PRICES).read().collect()}
    assert rows == {day("2024-01-01"): None, day("2024-02-01"): "x"}


def test_readers_keep_their_version_and_old_folders_expire(spark, store):
    table = PublishedTable(spark, store, PRICES)
    for n in range(1, 5):
        save.save_dataset(spark, store, PRICES, prices(spark, ("2024-01-01", float(n), f"2024-01-0{n}")))
    assert table.read(version=2).first()["value"] == 2.0
    old = sorted(b["v"] for n in (1, 2) for b in table.manifest(n).buckets.values())
    assert table.expire_versions(keep=2) == []  # too young: they may belong to a running job
    assert table.expire_versions(keep=2, hours=-1) == old
    assert table.read().first()["value"] == 4.0
    assert table.read(version=3).first()["value"] == 3.0
    assert read_lineage(spark, store).count() == 4


def test_second_writer_of_a_version_is_refused(spark, store):
    table = PublishedTable(spark, store, PRICES)
    batch = prices(spark, ("2024-01-01", 1.0, "2024-01-01"))
    base = table.manifest()
    a, b = table.stage(batch), table.stage(batch)
    assert a != b
    table.commit(base, a, table.staged_counts(a, batch.schema), batch.schema)
    with pytest.raises(ConcurrentPublish):
        table.commit(base, b, table.staged_counts(b, batch.schema), batch.schema)


def test_a_job_that_dies_before_its_commit_leaves_nothing(spark, store):
    save.save_dataset(spark, store, PRICES, prices(spark, ("2024-01-01", 1.0, "2024-01-01")))
    table = PublishedTable(spark, store, PRICES)
    table.stage(prices(spark, ("2024-01-01", 9.0, "2024-02-01")))
    assert stored(spark, store) == {day("2024-01-01"): 1.0}
    save.save_dataset(spark, store, PRICES, prices(spark, ("2024-01-01", 2.0, "2024-02-01")))
    assert stored(spark, store) == {day("2024-01-01"): 2.0}


def test_lineage(spark, store):
    batch = prices(spark, ("2024-01-01", 1.0, "2024-01-01"))
    save.save_dataset(spark, store, PRICES, batch, extra={"run": 7})
    row = read_lineage(spark, store).first()
    assert (row["dataset"], row["row_count"], row["column_count"]) == ("prices", 1, 3)
    assert [c["name"] for c in row["columns"]] == ["date", "value", "last_fetched_at"]
    assert row["extra"] == {"run": "7"} and row["written_at"] is not None


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_root(spark, "x"), scratch_root(spark, "x")
    assert one.startswith(f"{shared}/x-") and one != two


def test_key_reads_need_a_key(spark, store):
    with pytest.raises(ValueError):
        PublishedTable(spark, store, DATASETS["ecb_hicp"]).read_key("x")


# -- by item ------------------------------------------------------------------


def test_items_are_saved_together_and_failures_stay_out(spark, store):
    batch = bars(spark, ("AAPL", "2024-01-01", 1.0, "2024-01-01"), ("MSFT", "2024-01-01", 2.0, "2024-01-01"), ("BAD", None, 3.0, "2024-01-01"))
    ledger = save.save_by_item(spark, store, BARS, batch, run_id="r1")
    assert {r["item"]: r["status"] for r in ledger.collect()} == {"AAPL": "saved", "MSFT": "saved", "BAD": "failed"}
    assert sorted(r["ticker"] for r in save.read_dataset(spark, store, "daily_bars").collect()) == ["AAPL", "MSFT"]
    assert save.read_dataset(spark, store, "daily_bars", key="aapl").count() == 1
    report = run_report(ledger).first()
    assert (report["ok"], report["total"], report["saved"], report["failed"]) == (False, 3, 2, 1)


def test_an_item_with_dates_in_other_buckets_passes(spark, store):
    save.save_by_item(spark, store, BARS, bars(spark, ("AAPL", "2024-01-01", 1.0, "2024-01-01")))
    ledger = save.save_by_item(spark, store, BARS, bars(spark, ("AAPL", None, 2.0, "2024-01-01"), ("NEW", None, 2.0, "2024-01-01")), run_id="r2")
    assert {r["item"]: r["status"] for r in ledger.collect()} == {"AAPL": "saved", "NEW": "failed"}
    assert save.read_dataset(spark, store, "daily_bars").count() == 2


def gated(gate: dict):
    return replace(BARS, gate=replace(BARS.gate, **gate))


def test_a_failing_item_keeps_its_stored_rows(spark, store):
    dataset = gated({"min_date": "2000-01-01"})
    save.save_by_item(spark, store, dataset, bars(spark, ("A", "2024-01-02", 1.0, "2024-01-02"), ("B", "2024-01-02", 1.0, "2024-01-02")))
    batch = bars(spark, ("A", "1800-01-01", 9.0, "2024-01-03"), ("A", "2024-01-02", 9.0, "2024-01-03"), ("B", "2024-01-03", 2.0, "2024-01-03"))
    ledger = save.save_by_item(spark, store, dataset, batch, run_id="r2")
    assert {r["item"]: (r["status"], r["reason"]) for r in ledger.collect()} == {"A": ("failed", "min_date: 1800-01-01"), "B": ("saved", None)}
    rows = sorted((r["ticker"], str(r["date"]), r["close"]) for r in PublishedTable(spark, store, dataset).read().collect())
    assert rows == [("A", "2024-01-02", 1.0), ("B", "2024-01-02", 1.0), ("B", "2024-01-03", 2.0)]


def test_bounds_hold_over_all_buckets(spark, store):
    dataset = gated({"max_rows": 10})
    first = [("A", f"2024-01-{d:02d}", 1.0, "2024-01-31") for d in range(1, 10)]
    save.save_by_item(spark, store, dataset, bars(spark, *first))
    more = [("A", f"2024-02-{d:02d}", 1.0, "2024-02-28") for d in range(1, 10)]
    ledger = save.save_by_item(spark, store, dataset, bars(spark, *more, ("B", "2024-02-01", 1.0, "2024-02-28")), run_id="r2")
    assert {r["item"]: r["status"] for r in ledger.collect()} == {"A": "failed", "B": "saved"}
    assert PublishedTable(spark, store, dataset).read().count() == 10


def test_only_failing_items_publish_nothing(spark, store):
    save.save_by_item(spark, store, BARS, bars(spark, ("A", "2024-01-02", 1.0, "2024-01-02")))
    ledger = save.save_by_item(spark, store, BARS, bars(spark, ("NEW", None, 2.0, "2024-01-01")), run_id="r2")
    assert [r["status"] for r in ledger.collect()] == ["failed"]
    assert PublishedTable(spark, store, BARS).manifest().version == 1


def test_ties_are_settled_alike_in_every_path(spark, tmp_path):
    days = [str(day("2020-01-01") + dt.timedelta(days=31 * k)) for k in range(240)]
    ties = bars(spark, *[("A", d, float(k), "2024-01-01") for d in days for k in range(4)])
    old = bars(spark, *[("A", d, -1.0, "2023-01-01") for d in days])

    def after(store: str, *batches) -> list:
        for batch in batches:
            save.save_by_item(spark, store, BARS, batch)
        return sorted((r["date"], r["close"]) for r in PublishedTable(spark, store, BARS).read().collect())

    first = after(f"{tmp_path}/a", ties)
    assert after(f"{tmp_path}/b", old, ties) == first
    assert after(f"{tmp_path}/c", old.limit(3), ties.repartition(5)) == first


def test_columns_with_names_of_folders(spark, store):
    rows = prices(spark, ("2024-01-01", 1.0, "2024-01-01")).withColumns({"v": F.lit("x"), "bucket": F.lit("y")})
    for _ in range(2):
        assert save.save_dataset(spark, store, PRICES, rows).status == "saved"
    row = PublishedTable(spark, store, PRICES).read().first()
    assert (row["v"], row["bucket"], row["date"]) == ("x", "y", day("2024-01-01"))
    with pytest.raises(ValueError, match="reserved"):
        PublishedTable(spark, store, PRICES).stage(rows.withColumn("__bucket", F.lit(1)))


def test_of_two_writers_one_is_refused(spark, store):
    table = PublishedTable(spark, store, PRICES)
    save.save_dataset(spark, store, PRICES, prices(spark, ("2024-01-01", 1.0, "2024-01-01")))
    base = table.manifest()
    mine, theirs = (table.stage(prices(spark, ("2024-01-01", v, "2024-01-02"))) for v in (2.0, 3.0))
    assert mine != theirs
    table.commit(base, mine, table.staged_counts(mine, base.schema), base.schema)
    with pytest.raises(ConcurrentPublish):
        table.commit(base, theirs, table.staged_counts(theirs, base.schema), base.schema)
    assert table.read().first()["value"] == 2.0


def test_items_have_their_own_start_date(spark, store):
    rows = [("A", "2024-01-31", 1.0, "2024-02-01"), ("B", "2024-01-10", 1.0, "2024-02-01"), ("A", "2024-01-05", 1.0, "2024-02-01")]
    save.save_by_item(spark, store, BARS, bars(spark, *rows))
    newer = [(t, d, 2.0, "2024-03-01") for t, d, _, _ in rows] + [("C", "2024-01-01", 2.0, "2024-03-01")]
    save.save_by_item(spark, store, BARS, bars(spark, *newer), lookback_days=7)
    got = {(r["ticker"], r["date"]): r["close"] for r in save.read_dataset(spark, store, "daily_bars").collect()}
    assert got == {
        ("A", day("2024-01-31")): 2.0, ("B", day("2024-01-10")): 2.0,
        ("A", day("2024-01-05")): 1.0, ("C", day("2024-01-01")): 2.0,
    }


def outcomes_of(spark, store: str, run_id: str) -> dict:
    return {r["item"]: (r["status"], r["reason"], r["landed"], r["taken"], r["kept"], r["replaced"]) for r in read_outcomes(spark, store, run_id).collect()}


def test_only_what_changed_the_store_is_saved(spark, store):
    first = [("A", "2024-01-31", 1.0, "2024-02-01"), ("B", "2024-01-31", 1.0, "2024-02-01"), ("C", "2024-01-31", 1.0, "2024-02-01")]
    save.save_by_item(spark, store, BARS, bars(spark, *first))
    batch = [
        ("A", "2024-01-02", 2.0, "2024-03-01"), first[1], ("C", "2024-01-31", 2.0, "2024-03-01"), ("C", "2024-02-01", 2.0, "2024-03-01"),
        ("C", "2024-02-01", 3.0, "2024-03-02"),
    ]
    save.save_by_item(spark, store, BARS, bars(spark, *batch), lookback_days=7, run_id="r2")
    assert outcomes_of(spark, store, "r2") == {
        "A": ("skipped", "before the start date", 1, 0, 0, 0), "B": ("skipped", "nothing new", 1, 1, 0, 0), "C": ("saved", None, 3, 3, 2, 1),
    }
    version = PublishedTable(spark, store, BARS).manifest().version
    ledger = save.save_by_item(spark, store, BARS, bars(spark, *batch[:2]), lookback_days=7, run_id="r3")
    assert {r["item"]: r["status"] for r in ledger.collect()} == {"A": "skipped", "B": "skipped"}
    assert PublishedTable(spark, store, BARS).manifest().version == version


def test_a_job_that_dies_before_its_commit_has_no_ledger(spark, store, monkeypatch):
    batch = bars(spark, ("A", "2024-01-02", 1.0, "2024-01-02"))
    commit = PublishedTable.commit
    monkeypatch.setattr(PublishedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        save.save_by_item(spark, store, BARS, batch, run_id="r1")
    assert outcomes_of(spark, store, "r1") == {}
    monkeypatch.setattr(PublishedTable, "commit", commit)
    for _ in range(2):
        save.save_by_item(spark, store, BARS, batch, run_id="r1")
    # The run that was started again found nothing new: its rows are the run's ledger.
    assert outcomes_of(spark, store, "r1") == {"A": ("skipped", "nothing new", 1, 1, 0, 0)}


def test_a_batch_without_a_key_is_reported(spark, store):
    batch = bars(spark, ("A", "2024-01-02", 1.0, "2024-01-02")).drop("date")
    ledger = save.save_by_item(spark, store, BARS, batch, run_id="r1").collect()
    assert [(r["item"], r["status"], r["reason"]) for r in ledger] == [("A", "failed", "required_columns: missing: date")]


def test_start_dates_come_from_marks(spark, store, monkeypatch):
    months = [("A", f"2023-{m:02d}-15", 1.0, "2024-01-01") for m in range(1, 13)] + [("B", "2023-03-15", 1.0, "2024-01-01")]
    save.save_by_item(spark, store, BARS, bars(spark, *months), lookback_days=7)
    table = PublishedTable(spark, store, BARS)
    marks = {r["item"]: r["newest"] for r in read_marks(table, table.manifest()).collect()}
    assert marks == {"A": day("2023-12-15"), "B": day("2023-03-15")}
    seen, read = set(), PublishedTable.read

    def watched(self, version=None, keep=None, manifest=None, with_bucket=False):
        if self.root == table.root:
            names = (manifest or self.manifest(version)).buckets
            seen.update(n for n in names if keep is None or keep(bucket_value(n)))
        return read(self, version, keep, manifest, with_bucket)

    monkeypatch.setattr(PublishedTable, "read", watched)
    newer = bars(spark, ("A", "2023-12-15", 2.0, "2024-02-01"), ("A", "2023-12-16", 2.0, "2024-02-01"), ("A", "2023-05-15", 9.0, "2024-02-01"))
    save.save_by_item(spark, store, BARS, newer, lookback_days=7)
    # Of twelve buckets, the increment has read the one it touches.
    assert seen == {"__bucket=2023-12-01"}
    assert {r["item"]: r["newest"] for r in read_marks(table, table.manifest()).collect()}["A"] == day("2023-12-16")
    # Another kind of save makes the marks stale: they are taken from the rows again.
    monkeypatch.undo()
    save.save_dataset(spark, store, BARS, bars(spark, ("B", "2023-09-01", 1.0, "2024-03-01")))
    assert {r["item"]: r["newest"] for r in read_marks(table, table.manifest()).collect()}["B"] == day("2023-09-01")


def test_details_have_no_date_and_are_saved(spark, store):
    rows = spark.createDataFrame([("AAPL", "Apple", ts("2024-01-01"))], "ticker STRING, name STRING, last_fetched_at TIMESTAMP")
    ledger = save.save_by_item(spark, store, "ticker_details", rows)
    assert [r["status"] for r in ledger.collect()] == ["saved"]
    assert save.read_dataset(spark, store, "ticker_details").count() == 1


def test_a_large_bucket_is_merged_whole(spark, store):
    rows = [("A", f"2024-01-{1 + i % 28:02d}", float(i), "2024-01-01") for i in range(28)]
    save.save_dataset(spark, store, BARS, bars(spark, *rows))
    save.save_dataset(spark, store, BARS, bars(spark, *[(t, d, c + 1, "2024-02-01") for t, d, c, _ in rows]))
    table = PublishedTable(spark, store, BARS)
    assert table.read().agg(F.sum("close")).first()[0] == sum(range(28)) + 28


def test_every_dataset_can_be_stored(spark, store):
    """An empty batch of every catalogue entry goes through the save path."""
    for dataset in DATASETS.values():
        empty = spark.createDataFrame([], dataset.schema)
        assert save.save_dataset(spark, store, dataset, empty).status == "skipped"
        assert set(dataset.keys) <= set(dataset.schema.fieldNames())
        assert set(dataset.write_keys) == set(dataset.keys)


# -- load ---------------------------------------------------------------------


def test_load_takes_all_tickers_and_only_shared_columns(spark, store):
    save.save_dataset(spark, store, BARS, bars(spark, ("A", "2024-01-01", 1.0, "2024-01-01"), ("B", "2024-01-01", 2.0, "2024-01-01")).withColumn("extra_column", F.lit(1)))
    report = load.load_all(spark, store, f"{store}/t", ["market_data_daily", "ecb_hicp"])
    assert {r["table"]: (r["status"], r["rows"]) for r in report.collect()} == {"market_data_daily": ("loaded", 2), "ecb_hicp": ("skipped", 0)}
    counts = load.table_counts(spark, f"{store}/t", ["market_data_daily", "ecb_hicp"])
    assert {r["table"]: r["rows"] for r in counts.collect()} == {"market_data_daily": 2, "ecb_hicp": None}
    loaded = PublishedTable(spark, f"{store}/t", TABLES["market_data_daily"].dataset()).read()
    assert loaded.columns == TABLES["market_data_daily"].schema.fieldNames()


def test_load_skips_and_defaults(spark, store):
    undated = spark.createDataFrame([(1.0,)], "value DOUBLE")
    assert load.load_table(spark, store, "ecb_hicp", undated)[1:3] == ("skipped", "no date column")
    other = spark.createDataFrame([(1,)], "zzz INT")
    assert load.load_table(spark, store, "fundamentals_overview", other)[2] == "no matching columns"
    rows = spark.createDataFrame([(day("2024-01-01"), 1.0, "s")], "date DATE, value DOUBLE, series_id STRING")
    assert load.load_table(spark, store, "ecb_hicp", rows)[1] == "loaded"
    # An empty source leaves the table as it is.
    assert load.load_table(spark, store, "ecb_hicp", rows.limit(0))[1] == "skipped"
    row = PublishedTable(spark, store, TABLES["ecb_hicp"].dataset()).read().first()
    assert row["source"] == "ECB" and row["last_fetched_at"] is not None


def test_curve_components_load_into_one_table(spark, store):
    schema = DATASETS["gsw_zero_coupon"].schema
    for name, series in (("gsw_zero_coupon", "THREEFY1"), ("gsw_term_premiums", "THREEFYTP1")):
        rows = spark.createDataFrame([(day("2024-01-01"), "1Y", 1.0, series, name, "FRED", ts("2024-01-01"))], schema)
        assert save.save_dataset(spark, store, name, rows).status == "saved"
    report = load.load_all(spark, store, f"{store}/t", ["fred_yield_curves"]).first()
    assert (report["status"], report["rows"], report["columns"]) == ("loaded", 2, 7)


# -- rollups and upkeep -------------------------------------------------------


def test_refresh_window_holds_whole_buckets_only():
    window = rollup.refresh_window
    assert window(ROLLUPS["ohlcv_monthly"], day("2024-06-15")) == (day("2024-04-01"), day("2024-06-01"))
    assert window(ROLLUPS["ohlcv_monthly"], day("2024-06-01")) == (day("2024-03-01"), day("2024-05-01"))
    assert window(ROLLUPS["gdp_quarterly"], day("2024-05-31")) == (day("2022-07-01"), day("2024-04-01"))
    assert rollup.add_months(day("2024-03-31"), -1) == day("2024-02-29")
    assert rollup.add_months(day("2024-12-31"), 2) == day("2025-02-28")
    assert rollup.add_months(day("2024-11-30"), 1) == day("2024-12-30")


def test_refresh_equals_full_recompute_inside_the_window(spark, store):
    def rows(factor, fetched):
        return [(t, f"2024-{m:02d}-{d:02d}", factor * (m * 100.0 + d), fetched) for t in "AB" for m in range(1, 7) for d in (3, 17)]

    target = f"{store}/t"
    save.save_dataset(spark, store, BARS, bars(spark, *rows(1, "2024-07-01")))
    load.load_all(spark, store, target, ["market_data_daily"])
    before = rollup.build_rollup(spark, target, "ohlcv_monthly")
    old = {(r["bucket"], r["ticker"]): r for r in rollup.read_rollup(spark, target, "ohlcv_monthly").collect()}
    save.save_dataset(spark, store, BARS, bars(spark, *rows(2, "2024-08-01")))
    load.load_all(spark, store, target, ["market_data_daily"])
    assert rollup.refresh_rollup(spark, target, "ohlcv_monthly", day("2024-06-20")) == 4
    base = PublishedTable(spark, target, TABLES["market_data_daily"].dataset()).read()
    full = {(r["bucket"], r["ticker"]): r for r in roll_up(base, ROLLUPS["ohlcv_monthly"]).collect()}
    now = {(r["bucket"], r["ticker"]): r for r in rollup.read_rollup(spark, target, "ohlcv_monthly").collect()}
    assert len(now) == before == 12
    for key, row in now.items():
        inside = day("2024-04-01") <= key[0] < day("2024-06-01")
        assert row["close"] == (full if inside else old)[key]["close"]


def test_retention_drops_whole_buckets_and_cuts_the_edge(spark, store):
    rows = [("A", d, 1.0, "2024-07-01") for d in ("2021-01-05", "2022-06-10", "2022-06-20", "2023-01-01", "2024-06-15")]
    save.save_dataset(spark, store, BARS, bars(spark, *rows))
    table = PublishedTable(spark, store, BARS)
    assert upkeep.retain(table, 24, day("2024-06-15")) == 3
    assert sorted(r["date"] for r in table.read().collect()) == [day("2022-06-20"), day("2023-01-01"), day("2024-06-15")]
    before, now = table.manifest(1).buckets, table.manifest().buckets
    assert now["__bucket=2023-01-01"] == before["__bucket=2023-01-01"]
    assert now["__bucket=2022-06-01"]["v"] != before["__bucket=2022-06-01"]["v"]
    assert upkeep.retain(table, 24, day("2024-06-15")) == 3
    assert table.manifest().version == 2


def test_compaction_rewrites_old_buckets_once(spark, store):
    rows = [(t, f"2024-{m:02d}-0{d}", 1.0, "2024-07-01") for t in "BA" for m in range(1, 7) for d in (1, 2)]
    save.save_dataset(spark, store, BARS, bars(spark, *rows))
    table = PublishedTable(spark, store, BARS)
    limit = upkeep.compact_limit(TABLES["market_data_daily"], day("2024-06-15"))
    assert upkeep.compact(table, limit, ("ticker",)) == ["2024-01-01", "2024-02-01"]
    assert upkeep.compact(table, limit, ("ticker",)) == []
    assert table.read().count() == 24
    # A later write makes the bucket due again.
    save.save_dataset(spark, store, BARS, bars(spark, ("C", "2024-01-01", 1.0, "2024-08-01")))
    assert upkeep.compact(table, limit, ("ticker",)) == ["2024-01-01"]


def test_policies_cover_every_time_table(spark, store):
    assert {t.name for t in TABLES.values() if t.retain_months} == {t.name for t in TABLES.values() if t.bucket_width}
    save.save_dataset(spark, store, BARS, bars(spark, ("A", "2020-01-01", 1.0, "2024-01-01"), ("A", "2024-01-01", 1.0, "2024-01-01")))
    load.load_all(spark, store, f"{store}/t", ["market_data_daily"])
    done = upkeep.apply_policies(spark, f"{store}/t", day("2024-06-15")).collect()
    assert [(r["table"], r["dropped_rows"], r["compacted_buckets"]) for r in done] == [("market_data_daily", 1, 1)]


def test_dates_prune_buckets(spark, store):
    rows = [("A", f"2024-{m:02d}-05", 1.0, "2024-07-01") for m in range(1, 7)]
    save.save_dataset(spark, store, BARS, bars(spark, *rows))
    table = PublishedTable(spark, store, BARS)
    df = table.read_dates(day("2024-02-05"), day("2024-03-31"))
    assert df.count() == 2
    assert len(df.inputFiles()) == 2
    assert table.max_date() == day("2024-06-05")


# -- ledgers ------------------------------------------------------------------


def test_state_log(spark, tmp_path):
    path = str(tmp_path / "state")
    schema = "source STRING, dataset STRING, symbol STRING, status STRING, timestamp TIMESTAMP"
    rows = [("AAPL", "ok", 1), ("BAD1", "failed", 2), ("BAD1", "ok", 3), ("BAD2", "failed", 4)]
    records = [("polygon", "bars", s, st, ts("2024-01-01") + dt.timedelta(minutes=m)) for s, st, m in rows]
    append_state(spark.createDataFrame(records[:2], schema), path)
    append_state(spark.createDataFrame(records[2:], schema), path)
    (tmp_path / "state" / "part-bad.json").write_text("not json\n\n")
    state = read_state(spark, path)
    assert [r["symbol"] for r in failed_symbols(state, "polygon", "bars").collect()] == ["BAD2"]
    assert last_status(state).where("symbol = 'BAD1'").first()["status"] == "ok"
    assert failed_symbols(state, "other", "bars").count() == 0
    reset_state(spark, path)
    assert read_state(spark, path).count() == 0


def test_latest_status_goes_by_time_not_by_position(spark):
    schema = "source STRING, dataset STRING, symbol STRING, status STRING, timestamp TIMESTAMP"
    rows = [("s", "d", "X", "ok", ts("2024-01-02")), ("s", "d", "X", "failed", ts("2024-01-01"))]
    assert last_status(spark.createDataFrame(rows, schema)).first()["status"] == "ok"


def test_task_report(spark):
    schema = "run_id STRING, task STRING, status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, error STRING"
    rows = [
        ("r", "a", "success", ts("2024-01-01T00:00:00"), ts("2024-01-01T00:00:10"), None),
        ("r", "b", "failed", ts("2024-01-01T00:00:12"), None, "boom"),
    ]
    row = task_report(spark.createDataFrame(rows, schema)).first()
    assert (row["tasks_run"], row["tasks_failed"], row["ok"], row["duration_seconds"]) == (2, 1, False, 12.0)


# -- streams ------------------------------------------------------------------


def test_landed_stream_equals_batch_and_survives_a_replay(spark, store, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    rows = [(f"2024-01-{1 + i % 10:02d}", float(i), f"2024-02-{1 + i:02d}") for i in range(25)]
    for i in range(5):
        part = [{"date": d, "value": v, "last_fetched_at": f"{f}T00:00:00Z"} for d, v, f in rows[i * 5 : i * 5 + 5]]
        (landing / f"{i}.json").write_text("\n".join(json.dumps(r) for r in part))

    def run(checkpoint):
        stream = landed_stream(spark, str(landing), "date DATE, value DOUBLE, last_fetched_at TIMESTAMP", files_per_batch=2)
        merge_stream(stream, store, PRICES, str(tmp_path / checkpoint)).awaitTermination()

    run("one")
    batch_store = f"{store}-batch"
    save.save_dataset(spark, batch_store, PRICES, prices(spark, *rows))
    want = stored(spark, batch_store)
    assert stored(spark, store) == want
    # The same files again, as after a lost checkpoint.
    run("two")
    assert stored(spark, store) == want


def test_rows_that_break_declared_keys_are_set_aside(spark, store):
    rows = bars(spark, ("A", "2024-01-01", 1.0, "2024-01-01"), ("A", "2024-01-01", 2.0, "2024-01-02"), ("B", None, 3.0, "2024-01-01"))
    done = load.load_table(spark, store, "market_data_daily", rows)
    assert done[1:4] == ("loaded", "set aside: 1 rows with null keys, 1 rows with repeated keys", 1)
    table = PublishedTable(spark, store, TABLES["market_data_daily"].dataset())
    assert [r["close"] for r in table.read().collect()] == [2.0]


def test_a_rollup_with_a_bucket_of_no_date_is_refreshed(spark, store):
    rows = bars(spark, ("A", "2024-01-01", 1.0, "2024-01-01"), ("A", "2024-02-01", 2.0, "2024-01-02"))
    base = PublishedTable(spark, store, TABLES["market_data_daily"].dataset())
    base.replace(rows.unionByName(bars(spark, ("B", None, 3.0, "2024-01-01"))))
    rollup.build_rollup(spark, store, "ohlcv_monthly")
    assert rollup.refresh_rollup(spark, store, "ohlcv_monthly", day("2024-03-05")) >= 1
    upkeep.retain(base, 24, day("2024-06-15"))


def test_a_stream_stops_on_a_failed_gate(spark, tmp_path):
    from tidemark.streaming import bucket_stream

    spark.createDataFrame([(ts("2024-01-01"), "k", 1.0)], "at TIMESTAMP, k STRING, x DOUBLE").write.parquet(f"{tmp_path}/in")
    dataset = Dataset(
        "totals", table_schema("bucket_start DATE", "k STRING", "total DOUBLE", "last_fetched_at TIMESTAMP"),
        keys=("bucket_start", "k"), date_column="bucket_start",
        gate=Gate(required=(), not_all_null=(), date_column="bucket_start", min_rows=5),
    )
    stream = spark.readStream.schema("at TIMESTAMP, k STRING, x DOUBLE").parquet(f"{tmp_path}/in")
    query = bucket_stream(stream, "at", ["k"], [F.sum("x").alias("total")], f"{tmp_path}/s", dataset, f"{tmp_path}/c")
    with pytest.raises(Exception, match="row_count"):
        query.awaitTermination()
    assert not PublishedTable(spark, f"{tmp_path}/s", dataset).exists()
