"""Toxicity: multiple-instance learning over sentences, trained from labels of whole documents."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, fold, small_batches, stored, text_or_empty

#: Most labelled documents of each label that a model is fitted on, chosen by a hash of their ids.
SAMPLE = 3_000
#: Bytes of the longest document that teaches; longer ones are scored like all others.
LONGEST_LESSON = 100_000
#: Most features of a model: those whose documents differ most by label.
FEATURES = 4_096
#: Smallest likelihood ratio (G²) between the labels for a feature to be considered.
SIGNIFICANT = 15.0

_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]*")
_WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)


def sentences(text: str) -> Iterator[tuple[int, str]]:
    """Start and text of every sentence that has more than white space; all characters lie in some sentence."""
    for found in _SENTENCE.finditer(text):
        if found.group().strip():
            yield found.start(), found.group()


def word_features(word: str) -> list[str]:
    """The word itself, marked, and its stems."""
    return [f"={word}", *(word[:k] for k in STEMS if len(word) >= k)]


class _Known(dict):
    """Feature ids of a word, kept for the words seen lately."""

    def __init__(self, ids: dict[str, int], limit: int = 200_000):
        super().__init__()
        self.ids, self.limit = ids, limit

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        self[word] = found = tuple(self.ids[f] for f in word_features(word) if f in self.ids)
        return found


def active(text: str, known: _Known) -> tuple[int, list[tuple[int, int, list[int]]]]:
    """Number of sentences, and (start, length, distinct feature ids) of those that have a feature."""
    count, rows = 0, []
    for start, sentence in sentences(text):
        count += 1
        held = {f for word in _WORD.findall(sentence.lower()) for f in known[word]}
        if held:
            rows.append((start, len(sentence), sorted(held)))
    return count, rows


@dataclass
class NoisyOr:
    """A sentence is toxic with the logistic of ``base`` plus its weights; a document if any sentence is."""

    ids: dict[str, int]
    weight: np.ndarray
    base: float

    def sentence(self, features: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.base + self.weight[features].sum(), -30, 30))))

    def document(self, count: int, shares: list[float]) -> float:
        """Noisy-or over all sentences; those without a feature have the base probability."""
        clean = (count - len(shares)) * np.log1p(np.exp(self.base))
        return float(-np.expm1(-clean + np.log1p(-np.array(shares, float)).sum()))


def fit(
    bags: list[tuple[int, list[list[int]]]], labels: np.ndarray, weights: np.ndarray, ids: dict[str, int],
    rounds: int = 400, rate: float = 0.1, ridge: float = 0.05,
) -> NoisyOr:
    """Likelihood of the noisy-or by Adam steps over all bags: (sentences, feature ids of those that have any).

    The base is held so low that sentences without a feature make a document of
    average length toxic with 2 % at most: length alone accuses nobody. With
    one label only, no feature is learned.
    """
    length = np.array([count for count, _ in bags], float)
    mean = max(1.0, float(np.average(length, weights=weights)) if len(bags) else 1.0)
    model = NoisyOr(ids, np.zeros(len(ids)), float(np.log(0.01 / mean)))
    if len(bags) == 0 or labels.min() == labels.max() or not ids:
        return model
    rows = [(d, held) for d, (_, found) in enumerate(bags) for held in found]
    bag = np.array([d for d, _ in rows], np.int64)
    sizes = np.array([len(held) for _, held in rows], np.int64)
    column = np.fromiter((f for _, held in rows for f in held), np.int64, sizes.sum())
    line = np.repeat(np.arange(len(rows)), sizes)
    plain = length - np.bincount(bag, minlength=len(bags))
    theta = np.append(model.weight, np.log(0.01 / mean))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    weights = weights / weights.mean()
    for step in range(1, rounds + 1):
        z = theta[-1] + np.bincount(line, theta[column], len(rows))
        soft, hit = np.logaddexp(0, z), 1 / (1 + np.exp(-z))
        total = plain * np.logaddexp(0, theta[-1]) + np.bincount(bag, soft, len(bags))
        pull = weights * np.where(labels == 1, 1 / np.expm1(np.maximum(total, 1e-9)), -1.0)
        by_row = pull[bag] * hit
        slope = np.append(np.bincount(column, by_row[line], len(ids)), by_row.sum() + (pull * plain).sum() / (1 + np.exp(-theta[-1])))
        slope[:-1] -= ridge * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        theta[-1] = np.clip(theta[-1], -20, np.log(0.02 / mean))
    return NoisyOr(ids, theta[:-1], float(theta[-1]))


def lessons(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """(label, share, text) of the sampled labelled documents outside the held-out fold, stored.

    ``share`` is the part of its label's rows that was drawn. The sample is
    drawn from the labels alone, so only the ids drawn, at most ``sample`` for
    each label, meet the documents; no text is shuffled. Equal texts teach once.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2)).select(
        F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("label")
    ).distinct()
    drawn = None
    for label in (0, 1):
        some = known.where(F.col("label") == label)
        chosen = stored(bounded(some, sample, "id"), "drawn")
        part = chosen.withColumn("share", F.lit(chosen.count() / max(1, some.count())))
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    found = texts.join(F.broadcast(drawn), "id").where(F.octet_length("text") <= LONGEST_LESSON)
    return stored(found.select("label", "share", "text").dropDuplicates(["label", "text"]), "lessons")


def significant(taught: DataFrame, features: int = FEATURES) -> list[str]:
    """Words and stems that toxic documents hold significantly more often; at most ``features``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tallies = {0: Counter(), 1: Counter()}
            for label, text in zip(batch["label"], batch["text"]):
                words = set(_WORD.findall(text.lower()))
                tallies[label].update({f for word in words for f in word_features(word)})
            keys = list(tallies[0].keys() | tallies[1].keys())
            yield pd.DataFrame({
                "feature": pd.Series(keys, dtype=object),
                "clean": pd.Series([tallies[0][k] for k in keys], dtype="int64"),
                "toxic": pd.Series([tallies[1][k] for k in keys], dtype="int64"),
            })

    totals = {row["label"]: row["count"] for row in taught.groupBy("label").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return []
    counted = taught.select("label", "text").mapInPandas(count, "feature string, clean long, toxic long")
    sums = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both = F.col("clean") + F.col("toxic")

    def part(seen: str, size: int):
        expected = both * (size / (clean + toxic))
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) / expected)).otherwise(0.0)

    ratio = 2 * (part("clean", clean) + part("toxic", toxic))
    more = F.col("toxic") * clean > F.col("clean") * toxic
    best = sums.where(more & (F.col("toxic") >= 2)).withColumn("ratio", ratio).where(F.col("ratio") >= SIGNIFICANT)
    return [row["feature"] for row in best.orderBy(F.desc("ratio"), "feature").limit(features).collect()]


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE,
) -> NoisyOr:
    """A model from at most ``sample`` labelled documents of each label, outside the held-out fold.

    Rows without a label of 0 or 1 teach nothing; an id with both labels
    teaches both. Bags weigh as many documents as they were drawn from.
    """
    taught = lessons(small_batches(docs), labels, id_col, text_col, label_col, sample)
    ids = {feature: k for k, feature in enumerate(significant(taught))}

    def bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Known(ids)
        for batch in batches:
            found = [active(text, known) for text in batch["text"]]
            yield pd.DataFrame({
                "label": batch["label"],
                "share": batch["share"],
                "count": pd.Series([count for count, _ in found], dtype="int64"),
                "held": pd.Series([[held for _, _, held in rows] for _, rows in found], dtype=object),
            })

    bags = taught.mapInPandas(bag, "label int, share double, count long, held array<array<int>>").collect()
    bags.sort(key=lambda row: (row["label"], row["count"], row["held"]))
    return fit(
        [(row["count"], row["held"]) for row in bags],
        np.array([row["label"] for row in bags], int),
        np.array([1 / row["share"] for row in bags], float),
        ids,
    )


def apply(docs: DataFrame, model: NoisyOr, id_col: str = "doc_id", text_col: str = "text", least: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, offending): ``offending`` are the sentences of ``least`` or more, in text order."""
    kind = "score double, offending array<struct<start:int,length:int,score:double>>"

    @F.pandas_udf(kind)
    def judge(texts: pd.Series) -> pd.DataFrame:
        known = _Known(model.ids)
        scores, offending = [], []
        for text in texts:
            count, rows = active(text, known)
            shares = [model.sentence(held) for _, _, held in rows]
            scores.append(model.document(count, shares))
            offending.append([
                {"start": start, "length": length, "score": share}
                for (start, length, _), share in zip(rows, shares) if share >= least
            ])
        return pd.DataFrame({"score": pd.Series(scores, dtype=float), "offending": pd.Series(offending, dtype=object)})

    return small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"),
        (fold(id_col, 4) == 2).alias("held_out"),
        judge(text_or_empty(text_col)).alias("judged"),
    ).select("doc_id", "held_out", "judged.*")


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    least: float = 0.3,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, offending.

    Documents are bags of sentences. Only documents have labels; the noisy-or of
    the sentence scores is fitted to them, and the sentence scores then locate
    what offends (``offending``: start and length in characters, score).

    - The score depends on the text alone. Null, empty and blank texts have no
      sentence: score 0.
    - Every sentence of a very long text is scored, one text at a time; a text
      without sentence ends is one sentence.
    - A null id is never held out and never labelled; repeated rows are scored
      one by one; other columns, whatever their names, are ignored; an empty
      table gives no rows.
    - Without labels of both kinds no feature is learned.
    """
    model = learn(docs, labels, id_col, text_col, label_col)
    judged = apply(docs, model, id_col, text_col, least)
    return judged.select("doc_id", "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"), "offending")
