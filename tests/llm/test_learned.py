"""Learned operators: accuracy on held-out rows, hard rows, and parts against brute force."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import SF_DIR, hard_rows
from tidemark.llm import language_id, quality_classifier, quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{n}.parquet") for n in ("documents", "labels"))


def test_quality_held_out(tables):
    docs, labels = tables
    rows = quality_classifier.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_quality_hard_rows(hard, labels):
    rows = quality_classifier.score(hard, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in hard_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert quality_classifier.accepted(hard, labels).columns == hard.columns


def test_trees_walk_as_written():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(500, len(quality_classifier.STATISTICS)))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = quality_classifier.fit(x, y, trees=20)
    for row, score in zip(x[:40], model.score(x[:40])):
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_one_label_or_none(spark, hard, nothing, labels):
    assert quality_classifier.score(nothing, labels).count() == 0
    scores = {r.score for r in quality_classifier.score(hard, labels.where("quality = 1")).collect()}
    assert len(scores) == 1 and scores.pop() > 0.5
    assert {r.score for r in quality_classifier.score(hard, labels.limit(0)).collect()} == {0.5}


def test_languages_held_out(tables):
    docs, _ = tables
    rows = language_id.predict(docs).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_languages_hard_rows(hard, nothing):
    rows = {r.doc_id: r for r in language_id.predict(hard).collect()}
    assert {rows[i].lang_pred for i in (1, 2, 3, 14, 18)} == {"und"} and rows[1].score == 0
    assert rows[6].lang_pred == rows[13].lang_pred == "xx"
    assert language_id.predict(nothing).count() == 0


def test_code_lengths_are_exact():
    import pandas as pd

    text = b"abracadabra abracadabra"
    padded = b"\n\n\n" + text
    grams = pd.Series([int.from_bytes(padded[k : k + 4]) for k in range(len(text))]).value_counts()
    trees = language_id.ContextTrees(pd.DataFrame({"lang": "l", "gram": grams.index, "n": grams.to_numpy()}))

    def chance(context: bytes, byte: int) -> float:
        seen = [padded[k + 3] for k in range(len(text)) if padded[: k + 3].endswith(context)]
        shorter = (lambda b: chance(context[1:], b)) if context else (lambda b: 1 / 256)
        if not seen:
            return shorter(byte)
        different = set(seen)
        if byte in different:
            return seen.count(byte) / (len(seen) + len(different))
        return len(different) / (len(seen) + len(different)) * shorter(byte) / max(1 - sum(map(shorter, different)), 1e-12)

    other = b"cadabrab"
    want = -sum(np.log(chance((b"\n\n\n" + other)[k : k + 3], byte)) for k, byte in enumerate(other))
    assert trees.lengths([other])[0, 0] == pytest.approx(want, rel=1e-5)


def test_long_texts_are_cut_without_loss(monkeypatch):
    import pandas as pd

    trees = language_id.ContextTrees(pd.DataFrame({"lang": "l", "gram": [0x61626364], "n": [3]}))
    whole = trees.lengths([b"abcd" * 50, b"", b"x"])
    monkeypatch.setattr(language_id, "_CHUNK", 7)
    assert np.allclose(trees.lengths([b"abcd" * 50, b"", b"x"]), whole)


def brute_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORDS.findall(text)
    where: dict[tuple, list[int]] = {}
    for k in range(len(words) - 7):
        where.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {at + k for places in where.values() if len(places) > 1 for at in places for k in range(8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("source", ["hard", "tables"])
def test_counts(source, request):
    docs = request.getfixturevalue(source)
    docs = docs[0] if source == "tables" else docs
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((str(r.doc_id), *(r[n] for n in names)) for r in quality_rules.counted(docs).collect())
    assert got == sorted((str(r.doc_id), *brute_counts(r.text)) for r in docs.select("doc_id", "text").collect())


def test_rules_held_out(tables):
    docs, labels = tables
    rows = [
        r for r in quality_rules.judged(docs, labels).join(labels, "doc_id").collect()
        if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and not r.base_failed
    ]
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.95


def test_conditions_agree_with_rules(spark):
    draw = np.random.default_rng(1)
    x = np.abs(draw.normal(size=(600, len(quality_rules.FEATURES))))
    bad = (x[:, 1] > 1.2) | ((x[:, 4] > 0.8) & (x[:, 5] > 0.9))
    rules = quality_rules.cover(x, bad)
    assert rules and np.mean(np.any([r.holds(x) for r in rules], 0) == bad) > 0.9
    assert quality_rules.cover(x, np.zeros(600, bool)) == [] == quality_rules.cover(x[:0], bad[:0])


def test_rules_hard_rows(hard, nothing, labels):
    rows = quality_rules.judged(hard, labels)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    for r in rows.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality_rules.judged(nothing, labels).count() == 0
