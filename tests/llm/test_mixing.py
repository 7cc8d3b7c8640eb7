"""Poisson replication: rates, draws and order."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from tests.oracle import compare, connect
from tidemark.llm import mixing, queries


def test_rates_meet_the_weights(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 30 == 1, "small").otherwise("mid").alias("source")
    )
    sizes = Counter(r.source for r in docs.collect())
    made = Counter(r.source for r in mixing.replicate(docs, weights={"big": 1, "small": 1, "mid": 2}).collect())
    for source, share in {"big": 0.25, "small": 0.25, "mid": 0.5}.items():
        assert made[source] == pytest.approx(30_000 * share, rel=0.08), sizes


def test_draws_follow_the_distribution(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'s' as source")
    counts = Counter(Counter(r.doc_id for r in mixing.replicate(docs, epochs=2.0).collect()).values())
    for k in range(1, 6):
        assert counts[k] / 20_000 == pytest.approx(math.exp(-2) * 2**k / math.factorial(k), abs=0.012)


def test_order_is_global_and_repeatable(hard):
    rows = mixing.replicate(hard, epochs=3.0).collect()
    keys = [r.shuffle_key for r in rows]
    assert keys == sorted(keys) and rows == mixing.replicate(hard, epochs=3.0).collect()
    assert {tuple(r)[: len(hard.columns)] for r in rows} <= {tuple(r) for r in hard.collect()}


def test_unweighted_source_has_no_rows(hard, nothing):
    assert mixing.replicate(hard, weights={"other": 1.0}).count() == 0
    assert mixing.replicate(nothing).count() == 0


def test_many_sources_are_joined(spark, monkeypatch):
    docs = spark.range(500).selectExpr("id as doc_id", "cast(id % 50 as string) as source")
    want = mixing.replicate(docs).collect()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 10)
    assert mixing.replicate(docs).collect() == want


@pytest.mark.parametrize("broadcast", [20_000, 1])
def test_large_means_are_drawn(spark, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    docs = spark.range(40).selectExpr("id as doc_id", "if(id < 20, 'rare', 'other') as source")
    rows = mixing.replicate(docs, weights={"rare": 1.0, "other": 0.001}, epochs=2400.0).collect()
    copies = {}
    for r in rows:
        copies.setdefault((r.source, r.doc_id), []).append(r.copy)
    assert all(sorted(c) == list(range(len(c))) for c in copies.values())
    rare = np.array([len(c) for (source, _), c in copies.items() if source == "rare"])
    mean = 4800 / 1.001
    assert len(rare) == 20 and abs(rare.mean() - mean) < 5 * math.sqrt(mean / 20)
    assert 0.3 < rare.var(ddof=1) / mean < 2.5


def test_steps_end_at_one():
    for rate in (0.0, 0.1, 3.0, 450.0):
        steps = mixing._steps(rate)
        assert np.all(np.diff(steps) >= 0) and steps[-1] == pytest.approx(1, abs=1e-12)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_with_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) is None
