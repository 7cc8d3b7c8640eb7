"""Exact dedup against grouping in plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import hard_rows
from tidemark.llm.exact_dedup import classes, deduplicate, digests, merge_round, merge_runs, merge_sorted, sorted_runs


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_hard_rows(hard, keep):
    groups = defaultdict(list)
    for row in hard_rows():
        groups[row[1] or ""].append(row[0])
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max(known) if keep == "largest" else None if None in ids else min(known)) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, best, len(ids), sha) for i in ids]
    found = classes(hard, keep=keep).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == Counter(want)
    kept = Counter(r.text_sha256 for r in found if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_many_runs_merge_in_rounds(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "cast(id % 7 as string) as text").repartition(40)
    merged = merge_runs(digests(docs), fan_in=3)
    got = {(r.best.doc_id, r.copies) for r in merged.collect()}
    assert got == {(max(range(k, 4000, 7)), len(range(k, 4000, 7))) for k in range(7)}


def entries_of(page):
    raw, counts = bytes(page.entries), bytes(page.copies)
    assert len(raw) // 65 == len(counts) // 8
    return [raw[at : at + 65] for at in range(0, len(raw), 65)]


def test_runs_are_sorted_and_merged_in_two_rounds(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "cast(id % 900 as string) as text").repartition(9)
    found = digests(docs)
    assert found.select("run").distinct().count() == 9
    pages = sorted_runs(found, spans=5)
    sizes = []
    for left in (9, 3, 1):
        rows = pages.collect()
        assert {r.run for r in rows} == set(range(left))
        for run in range(left):
            mine = [e for r in sorted((r for r in rows if r.run == run), key=lambda r: (r.span, bytes(r.entries)[:65]))
                    for e in entries_of(r)]
            assert mine == sorted(mine) and len({e[:48] for e in mine}) == len(mine)
        sizes.append(sum(len(entries_of(r)) for r in rows))
        pages = merge_round(pages, 3)
    assert sizes[0] > sizes[1] > sizes[2] == 900


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_multiway_merge_against_a_plain_sort(keep):
    draw = np.random.default_rng(4)
    runs, want = [], {}
    for _ in range(5):
        keys = {bytes(draw.integers(0, 2, 48, np.uint8) * (np.arange(48) > 40)): bytes(draw.integers(0, 256, 17, np.uint8)) for _ in range(60)}
        entries = np.array(sorted(k + v for k, v in keys.items()), "S65")
        runs.append((entries, np.full(len(entries), 2)))
        for k, v in keys.items():
            best, copies = want.get(k, (v, 0))
            want[k] = (max(best, v) if keep == "largest" else min(best, v), copies + 2)
    entries, copies = merge_sorted(runs, keep)
    got = {e.ljust(65, b"\0")[:48]: (e.ljust(65, b"\0")[48:], int(c)) for e, c in zip(entries.tolist(), copies)}
    assert got == want and entries.tolist() == sorted(entries.tolist())


def test_rows_that_stay(hard):
    found = deduplicate(hard)
    assert found.columns == hard.columns
    texts = [r.text or "" for r in found.collect()]
    assert len(texts) == len(set(texts)) == len({r[1] or "" for r in hard_rows()})


def test_empty(nothing):
    assert classes(nothing).count() == deduplicate(nothing).count() == 0
