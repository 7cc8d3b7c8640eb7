"""Language ID: prediction by partial matching with frozen byte statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded, fold, small_batches
from tidemark.llm.tokens import has_letter

#: Most documents whose bytes are counted; every other step takes all documents.
SAMPLE = 6_000
ORDER = 3
_PAD = b"\n" * ORDER
_CHUNK = 1 << 19


def grams(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int) -> pd.DataFrame:
    """(lang, gram, n): each byte with the three before it, packed in 32 bits, over the teaching documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found: dict[int, int] = {}
                for text in texts:
                    raw = np.frombuffer(_PAD + text.encode("utf-8", "replace"), np.uint8).astype(np.uint32)
                    packed = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
                    for gram, n in zip(*(x.tolist() for x in np.unique(packed, return_counts=True))):
                        found[gram] = found.get(gram, 0) + n
                yield pd.DataFrame({"lang": lang, "gram": list(found.keys()), "n": list(found.values())})

    teaching = docs.where((fold(id_col, 5) != 0) & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    chosen = bounded(teaching, sample, "doc_id", "lang").select("lang", "text")
    rows = chosen.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    frame = pd.DataFrame(rows.collect(), columns=["lang", "gram", "n"])
    return frame.sort_values(["lang", "gram"], ignore_index=True)


class ContextTrees:
    """Code length of every byte after its context, for all languages at once.

    For each language, a byte seen ``c`` times after a context seen ``n`` times
    with ``d`` different bytes has probability c / (n + d). The escape, d / (n + d),
    is shared among the unseen bytes as the shorter context says, down to equal
    chances of 1 / 256. The counts are frozen, so all lengths lie in one table:
    a row for each context of two known bytes, then one for each of three that
    some language has seen.
    """

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique())
        gram = counts["gram"].to_numpy(np.int64)
        raw = np.stack([gram >> 24 & 255, gram >> 16 & 255, gram >> 8 & 255, gram & 255])
        known = np.unique(raw)
        self.size = size = len(known) + 1  # class 0: bytes never seen
        self.class_of = np.zeros(256, np.int64)
        self.class_of[known] = np.arange(1, size)
        first, second, third, byte = self.class_of[raw]
        context = (first * size + second) * size + third
        seen = np.unique(context)
        self.row = np.tile(np.arange(size * size), size)
        self.row[seen] = size * size + np.arange(len(seen))
        self.table = np.empty((size * size + len(seen), size, len(self.langs)), np.float32)
        n = counts["n"].to_numpy(float)
        for k, lang in enumerate(self.langs):
            own = counts["lang"].to_numpy() == lang
            c1, c2, c3, s, m = second[own], third[own], context[own], byte[own], n[own]

            def tally(rows: np.ndarray, many: int) -> np.ndarray:
                return np.bincount(rows * size + s, m, many * size).reshape(many, size)

            flat = np.full((1, size), 1 / 256)
            none = self._finer(tally(np.zeros_like(s), 1), flat)
            one = self._finer(tally(c2, size), none)
            two = self._finer(tally(c1 * size + c2, size * size), np.tile(one, (size, 1)))
            three = self._finer(tally(np.searchsorted(seen, c3), len(seen)), two[seen % (size * size)])
            self.table[:, :, k] = -np.log(np.concatenate([two, three]))

    @staticmethod
    def _finer(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Probabilities after longer contexts, given those after the shorter ones."""
        n, seen = counts.sum(1, keepdims=True), counts > 0
        d = seen.sum(1, keepdims=True)
        # Class 0 stands for each of the bytes that were never seen.
        rest = (shorter * ~seen).sum(1, keepdims=True) + (256 - counts.shape[1]) * shorter[:, :1]
        mixed = np.where(seen, counts, d * shorter / rest) / np.maximum(n + d, 1)
        return np.where(n > 0, mixed, shorter)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each whole text in every language, in nats."""
        total = np.zeros((len(texts), len(self.langs)))
        flat, size = self.table.reshape(-1, len(self.langs)), self.size
        many: list[int] = []
        parts: list[bytes] = []

        def flush() -> None:
            symbols = self.class_of[np.frombuffer(b"".join(parts), np.uint8)]
            context = (symbols[:-3] * size + symbols[1:-2]) * size + symbols[2:-1]
            costs = flat[self.row[context] * size + symbols[3:]]
            at = 0
            for k, part in zip(many, parts):
                total[k] += costs[at : at + len(part) - ORDER].sum(0, dtype=np.float64)
                at += len(part)
            many.clear(), parts.clear()

        held = 0
        for k, text in enumerate(texts):
            text = _PAD + text
            for at in range(0, len(text) - ORDER, _CHUNK):
                part = text[at : at + _CHUNK + ORDER]
                many.append(k), parts.append(part)
                held += len(part)
                if held >= _CHUNK:
                    flush()
                    held = 0
        if parts:
            flush()
        return total


_TREES: dict[int, ContextTrees] = {}


def predict(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from documents with a text and a language outside the held-out fold
    (crc32 of the id modulo 5 is 0; a null id is held out), from at most about
    ``sample`` of them. The language with the shortest code wins, the first by
    name on a tie; the score is its share when code lengths are read as
    probabilities. Null texts, texts without a letter, and all texts where
    nothing could be learned are ``und`` with score 0.
    """
    counts = grams(small_batches(docs), id_col, text_col, lang_col, sample)
    key = hash(tuple(map(tuple, counts.itertuples(index=False))))

    def guess(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _TREES and len(counts):
            _TREES.clear()
            _TREES[key] = ContextTrees(counts)
        trees = _TREES.get(key)
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            certain = np.array([trees is not None and (_plain_letter(t) or has_letter(t)) for t in texts], bool)
            names = np.full(len(texts), "und", object)
            scores = np.zeros(len(texts))
            if certain.any():
                lengths = trees.lengths([t.encode("utf-8", "replace") for t, c in zip(texts, certain) if c])
                best = lengths.argmin(1)
                share = 1 / np.exp(lengths.min(1, keepdims=True) - lengths).sum(1)
                names[certain] = np.array(trees.langs, object)[best]
                scores[certain] = share
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"],
                "lang_pred": names, "score": scores,
            })

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (fold(id_col, 5) == 0).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInPandas(guess, "doc_id long, held_out boolean, lang_pred string, score double")


def _plain_letter(text: str) -> bool:
    return text[:1].isascii() and text[:1].isalpha()
