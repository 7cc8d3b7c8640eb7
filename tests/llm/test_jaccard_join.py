"""Jaccard join against all pairs; trees against all bounds."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR, prose
from tidemark.llm import jaccard_join
from tidemark.llm.components import components
from tidemark.llm.jaccard_join import Tree, counts_of, folded, link, may_link, representatives, shingles, vector


def brute(docs, words: int, percent: int) -> dict:
    sets = []
    for r in docs.select("doc_id", "text").collect():
        parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), r.text or ""))
        width = min(words, len(parts))
        sets.append((r.doc_id, {tuple(parts[k : k + width]) for k in range(len(parts) - width + 1)} if parts else set()))
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in combinations([s for s in sets if s[1] and s[0] is not None], 2):
        if 100 * len(a & b) >= percent * len(a | b):
            low, high = sorted((root(i), root(j)))
            parent[high] = low
    return sorted((str(i), len(s), None if i is None else root(i)) for i, s in sets)


def result(docs, words: int = 4, percent: int = 85) -> list:
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in link(docs, words, percent).collect())


def test_hard_rows(hard, nothing):
    assert result(hard) == brute(hard, 4, 85)
    assert link(nothing).count() == representatives(nothing).count() == 0


@pytest.mark.parametrize("part", [2048, 20])
def test_chains_and_near_groups(spark, monkeypatch, part):
    monkeypatch.setattr(jaccard_join, "PART", part)
    draw = random.Random(2)
    texts = []
    for group in range(6):
        words = prose(group, 120).split()
        for _ in range(25):
            some = list(words)
            for _ in range(draw.choice([0, 1, 2, 4, 6])):
                some[draw.randrange(len(some))] = str(draw.random())
            texts.append(" ".join(some))
            if draw.random() < 0.3:
                words = some
    draw.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert result(docs) == brute(docs, 4, 85)
    assert result(docs, 5, 80) == brute(docs, 5, 80)
    kept = sorted(r.doc_id for r in representatives(docs, 5, 80).collect())
    assert kept == sorted({c for _, _, c in brute(docs, 5, 80)})


def test_hot_classes_are_not_copied_against_themselves(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART", 8)
    dealt, searched = [], jaccard_join._searched
    monkeypatch.setattr(jaccard_join, "_searched", lambda blocks, percent: dealt.append(blocks) or searched(blocks, percent))
    draw = random.Random(5)
    words, texts = prose(1, 120).split(), []
    for _ in range(150):
        some = list(words)
        some[draw.randrange(60, 120)] = str(draw.random())
        texts.append(" ".join(some))
    texts += [" ".join(words[:k]) for k in (40, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert result(docs) == brute(docs, 4, 85)
    blocks = dealt[0]
    hot = blocks.groupBy("token").agg(F.count_distinct("doc_id").alias("rows"), F.count(F.lit(1)).alias("copies")).where("rows > 100")
    assert hot.count() and hot.where("copies > 2 * rows").count() == 0
    large = blocks.join(hot.select("token"), "token")
    assert large.groupBy("task").count().agg(F.max("count")).first()[0] < 4 * 8


def test_blocks_hold_only_rows_that_may_link(spark, monkeypatch):
    kept, stored = {}, jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, label: kept.setdefault(label, stored(df, label)))
    words = prose(1, 200).split()
    texts = [" ".join(words[:k]) for k in (100, 150, 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(docs) == brute(docs, 4, 85)
    # They share many shingles, but none is close in size to another.
    assert kept["blocks"].count() == 0


def test_a_task_gets_a_set_once(spark, monkeypatch):
    given, linked = [], jaccard_join._linked
    monkeypatch.setattr(jaccard_join, "_linked", lambda blocks, percent: given.append(blocks) or linked(blocks, percent))
    draw, texts = random.Random(7), []
    for group in range(6):
        words = prose(group, 150).split()
        for _ in range(8):
            some = list(words)
            for _ in range(2):
                some[draw.randrange(len(some))] = str(draw.random())
            texts.append(" ".join(some))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert result(docs) == brute(docs, 4, 85)
    sets = given[0].select("task", "doc_id")
    assert sets.count() and sets.count() == sets.distinct().count()


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert result(docs) == brute(docs, 4, 85)


def test_tree_leaves_nothing_out():
    draw = np.random.default_rng(4)
    pool = draw.integers(0, 2**63, 900, dtype=np.uint64)
    sets = []
    for _ in range(300):
        base = pool[: draw.integers(3, 900)] if draw.random() < 0.5 else draw.choice(pool, draw.integers(1, 400))
        sets.append(np.unique(base[draw.random(len(base)) > draw.choice([0, 0.05])]))
    sets = sorted((s for s in sets if len(s)), key=len)
    sizes, classes = np.array([len(s) for s in sets]), draw.integers(0, 40, len(sets))
    tree = Tree(sizes, classes, [vector(s) if k % 50 else b"" for k, s in enumerate(sets)])
    found = {tuple(sorted(p)) for p in tree.pairs(85).tolist()}
    for i, j in combinations(range(len(sets)), 2):
        overlap = len(np.intersect1d(sets[i], sets[j]))
        if classes[i] != classes[j] and may_link(overlap, sizes[i] + sizes[j], 85):
            assert (i, j) in found


@pytest.mark.parametrize("groups", [32, 1 << 15])
def test_leaf_bounds(groups):
    draw = np.random.default_rng(groups)
    x, y = (draw.integers(0, 15, (n, groups)).astype(np.uint16) for n in (9, 32))
    want = [[int(np.minimum(a, b).sum()) for b in y] for a in x]
    assert jaccard_join._leaf_bounds(x, y).tolist() == want


def test_long_points_are_folded_in_a_tree():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 1 << 63, 70_000, np.uint64)) for _ in range(2)]
    sets.append(np.unique(np.concatenate([sets[0][:66_000], sets[1][:900]])))
    order = np.argsort([len(s) for s in sets])
    tree = Tree(np.array([len(sets[k]) for k in order]), order, [vector(sets[k]) for k in order])
    pairs = {tuple(sorted(order[list(p)].tolist())) for p in tree.pairs(80)}
    assert (0, 2) in pairs and (0, 1) not in pairs


def test_bounds_hold_for_folded_points():
    a, b = shingles(prose(1, 400), 4), shingles(prose(1, 330), 4)
    x, y = (counts_of([vector(s)])[0] for s in (a, b))
    assert x.sum() == len(a) and y.sum() == len(b)
    for groups in (128, 32, 16):
        assert np.minimum(folded(x, groups), folded(y, groups)).sum() >= len(np.intersect1d(a, b))


def test_components(spark):
    draw = random.Random(7)
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(draw.randint(200, 400), draw.randint(200, 400)) for _ in range(90)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(5)).collect()}
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: root(x) for x in parent if x not in alone}


@pytest.mark.parametrize("many", [300, 600, 1200])
def test_links_grow_with_the_documents(spark, monkeypatch, many):
    """Near copies of one text, a word changed in each: a forest of links, not all pairs."""
    draw = random.Random(many)
    base = prose(5, 50).split()
    rows = []
    for doc in range(many):
        words = list(base)
        words[draw.randrange(50)] = f"changed{doc}"
        rows.append((doc, " ".join(words)))
    counted, whole = [], jaccard_join.components

    def counting(links):
        counted.append(links.count())
        return whole(links)

    monkeypatch.setattr(jaccard_join, "components", counting)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.link(frame, words=5, percent=80).collect()}
    assert max(counted) <= 4 * many
    sets = {doc: set(jaccard_join.shingles(text, 5).tolist()) for doc, text in rows}
    for doc in range(0, many, 60):
        for other in range(many):
            both = len(sets[doc] & sets[other])
            if 100 * both >= 80 * (len(sets[doc]) + len(sets[other]) - both):
                assert found[doc] == found[other]
