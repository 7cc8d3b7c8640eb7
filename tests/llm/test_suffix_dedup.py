"""Suffix dedup against all substrings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SF_DIR
from tidemark.llm import suffix_dedup
from tidemark.llm.suffix_dedup import remove_repeats


def brute(docs, length: int) -> Counter:
    raws = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    seen = Counter(raw[k : k + length] for _, raw in raws for k in range(len(raw) - length + 1))
    rows = Counter()
    for doc, raw in raws:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        rows[doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return rows


def result(docs, **how) -> Counter:
    return Counter(tuple(r) for r in remove_repeats(docs, **how).collect())


@pytest.mark.parametrize("how", [{"length": 400, "gram": 280}, {"length": 40, "gram": 28}])
def test_hard_rows(hard, how):
    assert result(hard, **how) == brute(hard, how["length"])


def test_spliced_texts(spark):
    draw = random.Random(5)
    parts = ["".join(draw.choice("ab cd") for _ in range(draw.randint(5, 130))) for _ in range(14)]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 9))) for _ in range(60)] + ["a" * 200, "a" * 77, "ab" * 90]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert result(docs, length=60, gram=42) == brute(docs, 60)


def test_stretches_of_long_texts(spark, monkeypatch):
    draw = random.Random(6)
    shared = "".join(draw.choice("abcdefgh") for _ in range(300))
    texts = ["".join(draw.choice("abcdefgh") for _ in range(900)) + shared for _ in range(3)] + [shared * 2, shared[7:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw = texts[0].encode()
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 256)
    parts = list(suffix_dedup.segments(raw, 60, 42))
    assert sum(min(p.starts, 256) for p in parts) == len(raw) - 59
    assert result(docs, length=60, gram=42) == brute(docs, 60)


def _around_passage(seed: int) -> str:
    passage, draw = "".join(random.Random(400).choices("abcdefgh", k=390)), random.Random(seed)
    return "".join(draw.choices("ijklmnop", k=200)) + passage + "".join(draw.choices("ijklmnop", k=200))


@pytest.mark.parametrize("pair", [(333, 45306), (54465, 60801)])
def test_short_passage_of_many_texts_stays(spark, pair):
    """Neighbourhoods of a passage of 390 bytes whose hashes agree in 32 bits: no 400 bytes repeat."""
    docs = spark.createDataFrame([(k, _around_passage(k)) for k in pair], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed) for r in remove_repeats(docs).collect()} == {(k, 0) for k in pair}
    assert result(docs) == brute(docs, 400)


@pytest.mark.parametrize("doc", [1, None])
def test_rows_of_one_id_are_told_apart(spark, doc):
    """Two texts of one id (or of none) that have the same 32-bit hash; the first also comes under another id."""
    words = "a 4462" + " one" * 150
    other = "b 100578" + "".join(f" {k}" for k in range(1000, 1150))
    docs = spark.createDataFrame([(doc, words), (doc, other), (2, words + "!")], "doc_id long, text string")
    assert result(docs) == brute(docs, 400)


def test_spans_and_kept(spark):
    docs = spark.createDataFrame([(1, "x" + "abcdefghij" * 6), (2, "abcdefghij" * 6 + "é")], "doc_id long, text string")
    rows = {r.doc_id: r for r in remove_repeats(docs, length=60, gram=42, with_text=True).collect()}
    assert rows[1].spans == [[1, 61]] and bytes(rows[1].kept) == b"x"
    assert rows[2].spans == [[0, 60]] and bytes(rows[2].kept).decode() == "é"


def test_documents(spark, nothing):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert result(docs) == brute(docs, 400)
    assert remove_repeats(nothing).count() == 0
