"""Multiple-instance learning: sentences, the fit, held-out accuracy, hard rows."""

from __future__ import annotations

import numpy as np
import pytest

from tests.llm.conftest import SF_DIR, prose
from tidemark.llm import toxicity


def test_sentences_cover_every_character():
    text = "One two. Three!\n\n  \nfour?? five"
    found = list(toxicity.sentences(text))
    assert "".join(s for _, s in found).split() == text.split() and len(found) == 4
    assert all(text[start : start + len(s)] == s for start, s in found)
    assert list(toxicity.sentences(" \n\t")) == []


def test_noisy_or_is_one_minus_all_clean():
    model = toxicity.NoisyOr({"=a": 0, "=b": 1}, np.array([3.0, 1.0]), -4.0)
    shares = [model.sentence([0]), model.sentence([0, 1])]
    clean = (1 - shares[0]) * (1 - shares[1]) * (1 - 1 / (1 + np.exp(4))) ** 3
    assert model.document(5, shares) == pytest.approx(1 - clean)
    assert model.document(0, []) == 0


def test_fit_blames_the_sentence_word_and_not_its_company():
    # Feature 0 makes a bag toxic; feature 1 comes along in toxic and clean bags alike.
    bags = [(10, [[0], [1]]), (10, [[0, 1]]), (10, [[1]]), (10, [[1], [1]]), (10, [[0]]), (10, [])] * 20
    labels = np.array([1, 1, 0, 0, 1, 0] * 20)
    model = toxicity.fit(bags, labels, np.ones(len(bags)), {"a": 0, "b": 1})
    assert model.sentence([0]) > 0.8 and model.sentence([1]) < 0.2
    assert all((model.document(n, [model.sentence(h) for h in held]) >= 0.3) == bool(y) for (n, held), y in zip(bags, labels))


def planted(spark, rows: int = 400):
    """Every eighth document has one bad sentence, of an inflected stem."""
    docs, labels = [], []
    for i in range(rows):
        bad = i % 8 == 0
        tail = f" Well {prose(i + 7, 3)} zarkol{prose(i, 1)} here. " if bad else " "
        docs.append((i, prose(i, 30) + "." + tail + prose(i + 10_000, 30) + ".", "t", "x"))
        labels.append((i, int(bad), "x"))
    return spark.createDataFrame(docs, "doc_id long, text string, id string, share string"), spark.createDataFrame(labels, "doc_id long, toxic int, share string")


def test_planted_sentences_are_found_and_located(spark):
    docs, labels = planted(spark)
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == len(texts) and any(row["held_out"] for row in rows)
    for row in rows:
        assert row["predicted"] == int(row["doc_id"] % 8 == 0), row
        assert row["predicted"] == int(row["score"] >= 0.3) and 0 <= row["score"] <= 1
        if row["predicted"]:
            spans = [texts[row["doc_id"]][s["start"] : s["start"] + s["length"]] for s in row["offending"]]
            assert len(spans) == 1 and "zarkol" in spans[0]


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = planted(spark, 160)
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first = {r["doc_id"]: round(r["score"], 9) for r in toxicity.score(docs, labels).collect()}
    assert first == {r["doc_id"]: round(r["score"], 9) for r in toxicity.score(docs, turned).collect()}


def test_hard_rows(hard, labels):
    rows = toxicity.score(hard, labels).collect()
    assert len(rows) == hard.count()
    by_id = {}
    for row in rows:
        by_id.setdefault(row["doc_id"], []).append(row)
    assert all(by_id[i][0]["score"] == 0 for i in (1, 2, 3, 18))
    assert by_id[7][0] == by_id[7][1] and by_id[None][0]["held_out"] is False


def test_no_documents_or_no_labels(spark, nothing, hard, labels):
    assert toxicity.score(nothing, labels).collect() == []
    rows = toxicity.score(hard, labels.limit(0)).collect()
    assert len(rows) == hard.count() and all(0 <= row["score"] < 0.3 for row in rows if row["doc_id"] not in (11, 17))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet")
    labels = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/labels.parquet")
    rows = toxicity.score(docs, labels).where("held_out").join(labels, "doc_id").collect()
    clean = [row for row in rows if row["toxic"] == 0]
    toxic = [row for row in rows if row["toxic"] == 1]
    assert sum(row["predicted"] for row in clean) <= 0.02 * len(clean)
    assert sum(row["predicted"] for row in toxic) >= 0.6 * len(toxic)
