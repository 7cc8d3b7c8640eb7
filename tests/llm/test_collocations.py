"""Phrase counts and scores against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations as C

SCHEMA = "text string, lang string, phrase string, page long, n long"


def pieces(text: str | None) -> list[list[str]]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute(rows: list[tuple], least: int, longest: int, top: int) -> list[tuple]:
    f: Counter = Counter()
    n: Counter = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, words[i : i + size])
                if a >= f[part]:
                    covered.add(part)
    by_lang: dict[str, list] = {}
    for (lang, words), a in found.items():
        if (lang, words) in covered:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    out = []
    for lang, phrases in by_lang.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(phrases)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(spark, rows: list[tuple], parts: int = 3, **options) -> list[tuple]:
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA).repartition(parts)
    return sorted(tuple(row) for row in C.collocations(frame, **options).collect())


def corpus(seed: int, many: int) -> list[tuple]:
    draw = random.Random(seed)
    words = ["New", "york", "é", "Éa", "b-c", "zz", "\x0e", "日本"] + [f"w{k}" for k in range(12)]
    marks = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "! "]
    rows = []
    for _ in range(many):
        text = "".join(draw.choice(words) + draw.choice(marks) for _ in range(draw.randint(0, 60)))
        rows.append((text, draw.choice(["en", "de", None])))
    shared = rows[0][0]
    return rows + [(shared + " tail", "en")] * 9 + [(None, "en"), ("", None), ("New York city New York", "en")] * 3


@pytest.mark.parametrize("least, longest, trigger", [(2, 5, 3), (4, 5, 64), (3, 2, 7), (300, 5, 5)])
def test_like_brute_force(spark, monkeypatch, least, longest, trigger):
    monkeypatch.setattr(C, "PAGE_BYTES", 2_000)
    monkeypatch.setattr(C, "RANGE_ENTRIES", 50)
    rows = corpus(1, 90)
    assert got(spark, rows, least=least, longest=longest, top=50, trigger=trigger) == brute(rows, least, longest, 50)


def test_chunks_own_every_word_once():
    draw = random.Random(2)
    hashes = np.array([draw.randint(0, 5) for _ in range(500)], np.uint64)
    starts = C.chunk_starts(hashes, 4)
    assert starts[0] == 0 and (np.diff(starts) > 0).all() and len(starts) > 20
    # Where a chunk begins depends on the words there alone.
    moved = C.chunk_starts(np.append(np.array([9, 9, 9], np.uint64), hashes), 4)
    assert {s + 3 for s in starts.tolist() if s} <= set(moved.tolist())
    assert C.chunk_starts(np.zeros(0, np.uint64)).tolist() == [] and C.chunk_starts(hashes[:2]).tolist() == [0]


def test_copies_are_one_dictionary_entry(spark):
    text = " ".join(f"w{k % 97}x{k % 7}" for k in range(900))
    pages = C.parse(spark.createDataFrame([(text, "en")] * 50, "text string, lang string").repartition(4), trigger=16)
    once = C.parse(spark.createDataFrame([(text, "en")], "text string, lang string"), trigger=16)
    assert C.dictionary(pages).selectExpr("sum(size(times))").first()[0] == once.selectExpr("sum(size(digests))").first()[0]
    assert got(spark, [(text, "en")] * 50, least=60) == brute([(text, "en")] * 50, 60, 5, 2_000)


def test_long_text_and_repeats(spark):
    rows = [("the cat sat " * 30_000, "en"), ("a " * 20_000, "en"), ("the cat sat on", "en"), ("word" * 100_000, "en")]
    assert got(spark, rows, least=100) == brute(rows, 100, 5, 2_000)


def test_products_beyond_64_bits(spark):
    frame = spark.createDataFrame([(10**13, 10**15, 10**13, 10**13 - 1)], "a long, n long, l long, r long")
    from pyspark.sql import functions as F

    a, n, l, r = 10**13, 10**15, 10**13, 10**13 - 1
    assert frame.select(F.expr(C.SCORE).cast("long")).first()[0] == 1000 * a * n // (l * r)


def test_nothing(spark):
    assert got(spark, []) == [] and got(spark, [(None, None), ("one", "x")], least=1) == []


def test_hard_rows(spark, hard):
    rows = [(row["text"], row["lang"]) for row in hard.collect()]
    assert sorted(tuple(r) for r in C.collocations(hard, least=2).collect()) == brute(rows, 2, 5, 2_000)
