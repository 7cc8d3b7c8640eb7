"""Quality rules: decision lists learned from labelled statistics, applied as Spark conditions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import bind
from tidemark.llm.common import bounded, fold, stored

#: Most labelled documents that rules are learned from, chosen by a hash of their ids.
SAMPLE = 20_000

# White space that separates words; all else is part of one.
_SPACE = " \t\n\x0b\x0c\r"
_GAP = r"[\x20\x09-\x0D]+"
WINDOW = 8

#: What rules may ask about: shares and means, which do not depend on a text's length.
FEATURES = "mean_word symbol_share dup_line_share repeat_share upper_share exclaim_share".split()


def _count_of(text: Column, marks: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, marks, ""))).cast("long")


def _repeated(hashes: Column) -> Column:
    """How many words lie in a window of ``WINDOW`` words that the text holds twice or more.

    ``hashes`` are those of the words in order. Windows are hashed too, and
    sorted with their places; equal neighbours are repeats. Each repeated
    window adds the words up to the next one, at most its own.
    """

    def windows(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda at, k: F.least(F.get(places, k + 1) - at, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def again(pairs: Column) -> Column:
        def twin(pair: Column, k: Column) -> Column:
            before, after = F.get(pairs, k - 1)["h"], F.get(pairs, k + 1)["h"]
            return before.eqNullSafe(pair["h"]) | after.eqNullSafe(pair["h"])

        return F.sort_array(F.transform(F.filter(pairs, twin), lambda pair: pair["at"]))

    def count(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        repeats = bind(bind(pairs, again), covered)
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(repeats)

    return F.when(F.size(hashes) < WINDOW, F.lit(0).cast("long")).otherwise(bind(windows(hashes), count))


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts of every whole text, without a shuffle: one row per input row.

    A null or empty text has no words and zeros everywhere.
    """
    text = F.col("text")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    hashed = rows.select(
        "doc_id",
        "text",
        F.transform(F.filter(F.split(text, _GAP), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("words"),
        F.transform(
            F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, _SPACE, "")) > 0),
            lambda line: F.xxhash64(line),
        ).alias("lines"),
    )
    return hashed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, _SPACE, "")).cast("long").alias("word_chars"),
        _count_of(text, "#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("words")).alias("n_repeat_words"),
        _count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _count_of(text, "!").alias("n_exclaims"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def features() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "exclaim_share": F.col("n_exclaims") / chars,
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is_above, threshold); a text that meets all of it is rejected."""

    terms: tuple[tuple[str, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        met = np.ones(len(x), bool)
        for name, above, threshold in self.terms:
            column = x[:, FEATURES.index(name)]
            met &= (column > threshold) if above else (column <= threshold)
        return met

    def condition(self) -> Column:
        columns = features()
        parts = [columns[n] > t if above else columns[n] <= t for n, above, t in self.terms]
        return reduce(lambda a, b: a & b, parts)


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray]) -> Rule:
    """Adds the term with the largest information gain until no good text is covered or none gains."""
    terms: list[tuple[str, bool, float]] = []
    inside = np.ones(len(x), bool)
    while len(terms) < 4:
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        if n == 0 or p == 0:
            break
        best, choice = 1e-9, None
        for k, name in enumerate(FEATURES):
            for cut in cuts[k]:
                for above in (True, False):
                    met = inside & ((x[:, k] > cut) == above)
                    p1, n1 = (met & bad).sum(), (met & ~bad).sum()
                    if p1 == 0:
                        continue
                    gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                    if gain > best:
                        best, choice = gain, (name, above, float(cut))
        if choice is None:
            break
        terms.append(choice)
        inside = Rule(tuple(terms)).holds(x)
    return Rule(tuple(terms))


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The first terms of the rule that tell best on rows it was not grown on."""

    def worth(terms: int) -> tuple[float, int]:
        met = Rule(rule.terms[:terms]).holds(x)
        p, n = (met & bad).sum(), (met & ~bad).sum()
        return ((p - n) / (p + n) if p + n else -1.0), -terms

    return Rule(rule.terms[: max(range(1, len(rule.terms) + 1), key=worth)]) if rule.terms else rule


def cover(x: np.ndarray, bad: np.ndarray, most: int = 12, least_precision: float = 0.8) -> list[Rule]:
    """Sequential covering: rules for the rejected texts, each grown on two thirds of what the earlier ones leave.

    A rule is kept while it is right for ``least_precision`` of the other third's
    texts that it covers. Without both labels there are no rules.
    """
    rules: list[Rule] = []
    rows = np.arange(len(x))
    while len(rules) < most and bad[rows].sum() >= 3 and (~bad[rows]).any():
        held = rows % 3 == 2
        grow, test = rows[~held], rows[held]
        cuts = [np.unique(np.quantile(x[grow, k], np.linspace(0, 1, 34)[1:-1])) for k in range(len(FEATURES))]
        rule = _prune(_grow(x[grow], bad[grow], cuts), x[test], bad[test])
        met = rule.holds(x[test]) if rule.terms else np.zeros(0, bool)
        if not met.any() or bad[test][met].mean() < least_precision:
            break
        rules.append(rule)
        rows = rows[~rule.holds(x[rows])]
    return rules


def learn(counts: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    """A decision list from labelled counts; one fold of ids (crc32 modulo 3 is 1) is left for measuring."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")
    )
    usable = counts.where(fold("doc_id", 3) != 1).join(known, "doc_id")
    usable = usable.select("doc_id", "label", *[c.cast("double").alias(n) for n, c in features().items()])
    rows = sorted(bounded(usable, sample, "doc_id", "label").collect())
    x = np.array([r[2:] for r in rows], float).reshape(-1, len(FEATURES))
    return cover(x, np.array([r["label"] == 0 for r in rows], bool))


def verdict(rules: list[Rule]) -> Column:
    """True where no rule of the list holds, as one ordered condition."""
    if not rules:
        return F.lit(True)
    chain = F.when(rules[0].condition(), False)
    for rule in rules[1:]:
        chain = chain.when(rule.condition(), False)
    return chain.otherwise(True)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept.

    A text with fewer than 20 words (so each null or empty one), or with more
    than 30 of 100 words in repeated windows, fails the base and is not kept;
    of the others the learned list decides. Repeated rows are judged one by
    one, a null id is kept as it is, an empty table gives no rows, other
    columns are ignored.
    """
    counts = stored(counted(docs, id_col, text_col), "counts")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kept = ~failed & verdict(learn(counts, labels))
    return counts.select("*", failed.alias("base_failed"), kept.alias("kept"))
