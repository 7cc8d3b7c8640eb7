"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, fold, small_batches, stored, text_or_empty

#: Most labelled documents that a model is fitted on, chosen by a hash of their ids.
SAMPLE = 20_000

STATISTICS = (
    "log_bytes log_words mean_word longest_word lower upper digit symbol exclaim bar stop other_mark high line_breaks "
    "distinct_words distinct_triples distinct_lines upper_words mean_line capital_after_stop"
).split()

_CLASSES = ["lower", "upper", "digit", "symbol", "exclaim", "bar", "stop", "other_mark", "high", "line_breaks"]


def _byte_classes() -> np.ndarray:
    """Class of every byte; 10 is white space within a line."""
    classes = np.full(256, _CLASSES.index("other_mark"), np.uint8)
    classes[list(range(97, 123))] = 0
    classes[list(range(65, 91))] = 1
    classes[list(range(48, 58))] = 2
    for name, marks in (("symbol", b"#*$%&<>@^~=_+"), ("exclaim", b"!"), ("bar", b"|"), ("stop", b".,;:?")):
        classes[list(marks)] = _CLASSES.index(name)
    classes[128:] = _CLASSES.index("high")
    classes[10] = _CLASSES.index("line_breaks")
    classes[[9, 11, 12, 13, 32]] = 10
    return classes


_CLASS_OF = _byte_classes()


def statistics(text: str) -> list[float]:
    """The statistics of one whole text; an empty text has zeros."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    size = len(raw)
    share = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=11)[:10] / size
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, lengths = max(1, len(words)), list(map(len, words)) or [0]
    triples = max(1, len(words) - 2)
    return [
        np.log1p(size),
        np.log1p(len(words)),
        sum(lengths) / n,
        float(min(max(lengths), 1000)),
        *share.tolist(),
        len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:]))) / triples,
        len(set(lines)) / max(1, len(lines)),
        sum(map(bytes.isupper, words)) / n,
        np.log1p(size / max(1, len(lines))),
        raw.count(b". ") / n,
    ]


@dataclass
class Trees:
    """Complete trees as arrays: split ``feature`` and ``threshold`` by level, then ``leaf`` values."""

    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: all rows walk all trees level by level."""
        depth = int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**depth - 1)]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 1.0
) -> Trees:
    """Logistic loss, second-order splits on histograms of quantile bins.

    Without rows or with one label only, the score is the share of label 1
    (one half without rows).
    """
    nodes = 2**depth - 1
    share = (y.sum() + 1) / (len(y) + 2)
    model = Trees(np.zeros((0, nodes), int), np.zeros((0, nodes)), np.zeros((0, nodes + 1)), np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T)], 1)
    width, columns = bins + 1, x.shape[1]
    cells = binned + np.arange(columns) * width
    total = np.full(len(y), model.base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = y - p, p * (1 - p)
        feature, threshold = np.zeros(nodes, int), np.full(nodes, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (columns * width) + cells).ravel()
            shape = (many, columns, width)
            g = np.bincount(at, np.repeat(slope, columns), many * columns * width).reshape(shape).cumsum(2)
            h = np.bincount(at, np.repeat(curve, columns), many * columns * width).reshape(shape).cumsum(2)
            whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge) - whole_g**2 / (whole_h + ridge)
            gain[(h < 1) | (whole_h - h < 1)] = 0
            best = gain.reshape(many, -1).argmax(1)
            for k, cell in enumerate(best):
                column, bin_ = divmod(int(cell), width)
                if gain[k, column, bin_] > 1e-9 and bin_ < len(cuts[column]):
                    feature[first + k], threshold[first + k] = column, cuts[column][bin_]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf_of = node - nodes
        leaf = rate * np.bincount(leaf_of, slope, nodes + 1) / (np.bincount(leaf_of, curve, nodes + 1) + ridge)
        total += leaf[leaf_of]
        features.append(feature), thresholds.append(threshold), leaves.append(leaf)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), model.base)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, statistics) of every whole text, stored."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "held_out": batch["held_out"],
                "statistics": [statistics(text) for text in batch["text"]],
            })

    rows = small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"),
        (fold(id_col, 3) == 1).alias("held_out"),
        text_or_empty(text_col).alias("text"),
    )
    return stored(rows.mapInPandas(measure, "doc_id long, held_out boolean, statistics array<double>"), "statistics")


def learn(rows: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees fitted on labelled rows outside the held-out fold, at most ``sample`` of them.

    Rows without a label of 0 or 1 teach nothing; an id with several labels
    teaches each of them.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")
    )
    usable = rows.where("NOT held_out").join(known, "doc_id").select("doc_id", "label", "statistics")
    chosen = sorted(bounded(usable, sample, "doc_id", "label", "statistics").collect())
    x = np.array([r["statistics"] for r in chosen], float).reshape(-1, len(STATISTICS))
    return fit(x, np.array([r["label"] for r in chosen], float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    The score depends on the text alone. Null and empty texts have the same
    statistics and so the same score; a null id is never held out; repeated
    rows are scored one by one; other columns are ignored.
    """
    rows = measured(docs, id_col, text_col)
    model = learn(rows, labels)

    @F.pandas_udf("double")
    def walk(column: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(column.to_list()))) if len(column) else pd.Series([], dtype=float)

    scored = rows.select("doc_id", "held_out", walk("statistics").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose text scores 0.5 or more, with all their columns and without a shuffle of texts."""
    model = learn(measured(docs, id_col, text_col), labels)

    @F.pandas_udf("double")
    def walk(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(text) for text in texts], float).reshape(-1, len(STATISTICS))
        return pd.Series(model.score(x))

    return docs.where(walk(text_or_empty(text_col)) >= 0.5)
