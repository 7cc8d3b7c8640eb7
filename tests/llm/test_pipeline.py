"""The pipeline: each stage on what the one before kept."""

from __future__ import annotations

import corpus_pipeline
from __spark_entry__ import queries
from tests.llm.conftest import SF_DIR

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows = docs.collect()
        assert rows and {r.doc_id for r in rows} <= set(before)
        if name == "best_fit_packing":
            assert sorted({r.doc_id for r in rows}) == sorted(before)
            continue
        assert docs.columns == COLUMNS and all(r.text == before[r.doc_id] for r in rows)
        if name in ("exact_dedup", "jaccard_join"):
            assert len(rows) == len({r.text for r in rows})
        before = {r.doc_id: r.text for r in rows}


def test_stages_on_hard_rows(spark, hard, nothing):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, hard.select(*COLUMNS), SF_DIR).count()
        assert stage(spark, nothing.select(*COLUMNS), SF_DIR).count() == 0


def test_queries_are_registered():
    names = {n.split("_")[0] for n in queries()}
    assert {f"op{k}" for k in range(1, 11)} | {"pipeline"} <= names
