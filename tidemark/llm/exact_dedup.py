"""Exact dedup: sorted digest runs, exchanged and merged in binomial rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import matching, stored, text_or_empty, without

KEEP = ("smallest", "largest")
# Digests of one range of a merged run; a task holds the pages of ``fan_in`` runs for one range.
PAGE_ENTRIES = 100_000
# An entry in bytes: digest 32, text length 8, second hash 8, then the rank: id known 1, id 8, row 8.
_KEY, _ENTRY = 48, 65
_SIGN = np.uint64(1 << 63)
_PAGES = "run int, span long, entries binary, copies binary"
_MERGED = "digest binary, check struct<size: int, hash: bigint>, best struct<doc_id: bigint, row: bigint>, copies bigint"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(run, row, doc_id, digest, check), stored: one run for each input partition.

    ``check`` (byte length and a second hash) verifies that equal digests mean
    equal texts; where it differs, the texts count as different.
    """
    text = text_or_empty(text_col)
    return stored(
        docs.select(
            F.spark_partition_id().alias("run"),
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.struct(F.octet_length(text).alias("size"), F.xxhash64(text).alias("hash")).alias("check"),
        ),
        "digests",
    )


def _bytes(number: Column) -> Column:
    """Eight bytes, big end first."""
    return F.unhex(F.lpad(F.hex(number.cast("long")), 16, "0"))


def _entry() -> Column:
    """Text identity and rank as one binary value whose byte order is the order of a run."""
    known = F.col("doc_id").isNotNull()
    ranked = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))
    return F.concat(
        F.col("digest"),
        _bytes(F.col("check.size")),
        _bytes(F.col("check.hash")),
        F.when(known, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))),
        _bytes(ranked),
        _bytes(F.col("row")),
    )


def _fold(entries: np.ndarray, copies: np.ndarray, keep: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted entries with one for each text: the first or last of its stretch, copies summed."""
    keys = entries.view(np.uint8).reshape(-1, _ENTRY)[:, :_KEY]
    new = np.ones(len(entries), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(1)
    first = np.flatnonzero(new)
    best = first if keep == "smallest" else np.append(first[1:], len(entries)) - 1
    return entries[best], np.add.reduceat(copies, first)


def merge_sorted(runs: list[tuple[np.ndarray, np.ndarray]], keep: str) -> tuple[np.ndarray, np.ndarray]:
    """Multiway merge of sorted runs: an entry's place is the number of entries before it in all runs."""
    total = sum(len(entries) for entries, _ in runs)
    merged, counts = np.empty(total, f"S{_ENTRY}"), np.empty(total, np.int64)
    for i, (entries, copies) in enumerate(runs):
        place = np.arange(len(entries))
        for j, (other, _) in enumerate(runs):
            if j != i:
                place += np.searchsorted(other, entries, "right" if j < i else "left")
        merged[place], counts[place] = entries, copies
    return _fold(merged, counts, keep)


def sorted_runs(found: DataFrame, spans: int, keep: str = "largest") -> DataFrame:
    """The runs (run, span, entries, copies) in pages: a sorted run cut at ``spans`` equal digest ranges.

    The sort inside a partition is Spark's own and spills. A text that is in a
    run many times is one entry of a page, with its copies counted.
    """

    def page(run: int, entries: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
        head = np.ascontiguousarray(entries.view(np.uint8).reshape(-1, _ENTRY)[:, :4]).view(">u4").ravel()
        span = head.astype(np.int64) * spans >> 32
        starts = np.flatnonzero(np.diff(span, prepend=-1))
        ends = np.append(starts[1:], len(entries))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([run] * len(starts), pa.int32()),
                pa.array(span[starts], pa.int64()),
                pa.array([entries[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array([copies[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ],
            ["run", "span", "entries", "copies"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last text of a batch may go on in the next one.
        held: tuple[int, np.ndarray, np.ndarray] | None = None
        for batch in batches:
            runs = batch.column("run").to_numpy()
            entries = np.array(batch.column("entry").to_pylist(), f"S{_ENTRY}")
            for run in np.unique(runs):
                mine = entries[runs == run]
                copies = np.ones(len(mine), np.int64)
                if held and held[0] == run:
                    mine, copies = np.concatenate([held[1], mine]), np.concatenate([held[2], copies])
                elif held:
                    yield page(*held)
                mine, copies = _fold(mine, copies, keep)
                if len(mine) > 1:
                    yield page(run, mine[:-1], copies[:-1])
                held = (run, mine[-1:], copies[-1:])
        if held:
            yield page(*held)

    return (
        found.select("run", _entry().alias("entry")).sortWithinPartitions("run", "entry").mapInArrow(cut, _PAGES)
    )


def _rows(entries: np.ndarray, copies: np.ndarray) -> pa.Table:
    """(digest, check, best, copies), a row for each entry."""
    raw = entries.view(np.uint8).reshape(-1, _ENTRY)

    def number(start: int) -> np.ndarray:
        return np.ascontiguousarray(raw[:, start : start + 8]).view(">u8").ravel().astype(np.uint64)

    ids = pa.array((number(49) ^ _SIGN).view(np.int64), mask=raw[:, _KEY] == 0)
    check = [pa.array(number(32).astype(np.int32)), pa.array(number(40).view(np.int64))]
    digest = np.ascontiguousarray(raw[:, :32])
    offsets = np.arange(0, digest.size + 1, 32, dtype=np.int32)
    return pa.table(
        {
            "digest": pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(digest)]),
            "check": pa.StructArray.from_arrays(check, ["size", "hash"]),
            "best": pa.StructArray.from_arrays([ids, pa.array(number(57).view(np.int64))], ["doc_id", "row"]),
            "copies": pa.array(copies),
        }
    )


def merge_round(pages: DataFrame, fan_in: int, keep: str = "largest", last: bool = False) -> DataFrame:
    """Each ``fan_in`` neighbouring runs become one, digest range by digest range.

    The ``last`` round gives a row for each entry in place of pages.
    """

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        runs = [
            (np.frombuffer(e.as_py(), f"S{_ENTRY}"), np.frombuffer(c.as_py(), np.int64))
            for e, c in zip(table.column("entries"), table.column("copies"))
        ]
        entries, copies = merge_sorted(runs, keep)
        if last:
            return _rows(entries, copies)
        return pa.table(
            {
                "run": pa.array([key[0].as_py()], pa.int32()),
                "span": pa.array([key[1].as_py()], pa.int64()),
                "entries": pa.array([entries.tobytes()], pa.binary()),
                "copies": pa.array([copies.tobytes()], pa.binary()),
            }
        )

    grouped = pages.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).groupBy("run", "span")
    return grouped.applyInArrow(merge, _MERGED if last else _PAGES)


def merge_runs(found: DataFrame, keep: str = "largest", fan_in: int = 4) -> DataFrame:
    """(digest, check, best, copies): the best row of every text over all runs.

    Every input partition is a run, sorted by digest, length and second hash.
    In each round ``fan_in`` neighbouring runs are exchanged and merged; the
    merge compares all three and keeps the extreme id. Runs are cut at fixed
    digest ranges, of about ``PAGE_ENTRIES`` texts in the last run, and a task
    merges one range, so no task holds a run. A text that a third of all rows
    have is one entry in each run.
    """
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}, not {keep!r}")
    rows, last = found.agg(F.count(F.lit(1)), F.max("run")).first()
    pages = sorted_runs(found, max(8, -(-rows // PAGE_ENTRIES)), keep)
    runs = (last or 0) + 1
    while runs > fan_in:
        pages = merge_round(pages, fan_in, keep)
        runs = -(-runs // fan_in)
    return merge_round(pages, fan_in, keep, last=True)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, row, keep_id, group_size, kept, text_sha256.

    - A null text counts as empty; empty texts are equal to each other. Of a
      very long text only its digest leaves the first stage.
    - Of equal texts the row with the largest (or smallest) id stays; ids are
      integers. Where that id is repeated, one of its rows stays, the one that
      comes last (first).
    - Null ids rank below all others; an empty table gives no rows; other
      columns are ignored.
    """
    found = digests(docs, id_col, text_col)
    # One row for each text of a run brings the outcome back, so a hot text is spread over its runs.
    of_run = found.select("run", "digest", "check").distinct()
    best = of_run.join(merge_runs(found, keep), ["digest", "check"])
    return found.join(best, ["run", "digest", "check"]).select(
        "doc_id",
        "row",
        F.col("best.doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows that stay, with all their columns.

    Digests alone are merged; only texts whose id may be that of a dropped row
    are shuffled. Rows alike in id and text stay once.
    """
    found = stored(classes(docs, id_col, text_col, keep), "classes")
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "text_sha256")
    again = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("kept")).select("doc_id", "text_sha256")
    once = without(docs, gone, id_col, text_col)
    if again.isEmpty():
        return once
    twice = matching(once, again, id_col, text_col).dropDuplicates([id_col, text_col])
    return without(once, again, id_col, text_col).unionByName(twice)
