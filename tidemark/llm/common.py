"""What the text operators share: stored intermediates, folds, bounded id filters."""

from __future__ import annotations

import ctypes

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_root


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    This cuts the lineage: what follows reads files, so a lost executor costs
    one stage only, and no sampled or random step is computed twice.
    """
    path = scratch_root(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, rows: int = 1_000, size: int = 4 << 20) -> DataFrame:
    """``df``, in a session whose Arrow batches end at ``rows`` rows or about ``size`` bytes.

    Texts are long. A batch exists in the JVM and in the Python worker at once,
    and each worker of an executor has its own.
    """
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        # Spark shows a size with its unit; a value that is no plain number is replaced.
        now = str(conf.get(key)).removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(key, str(most))
    return df


def release() -> None:
    """Memory this worker has freed goes back to the system; the JVM and the other workers need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; null ids fall in fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds, F.lit(0)).cast("int")


class SlotFilter:
    """Which hash slots some ids occupy: a bitmap of fixed size, whatever the number of ids.

    A row whose slot is clear certainly has none of the ids. The bitmap does not
    grow with the data, so it may go to every task; an exact join follows.
    """

    def __init__(self, ids: DataFrame, column: str, bits: int = 1 << 22):
        self.bits = bits
        bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{column}`), {bits}L) & 63L as int))")
        word = F.shiftright(self.slot(column), 6).cast("int")
        rows = ids.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
        self.words = np.zeros(bits // 64, np.int64)
        for row in rows.collect():
            self.words[row["word"]] = row["bits"]

    def slot(self, column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(self.bits).cast("long"))

    def held(self, slots: pd.Series) -> np.ndarray:
        slots = slots.to_numpy(np.int64)
        return (self.words[slots >> 6] >> (slots & 63)) & 1 == 1

    def holds(self, column: str) -> Column:
        @F.pandas_udf("boolean")
        def held(slots: pd.Series) -> pd.Series:
            return pd.Series(self.held(slots))

        return held(self.slot(column))


def _split(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str | None):
    """``rows`` as join keys, ``docs`` that are surely not among them, the others, and how these match."""
    small_batches(docs)
    keys = rows.select(F.col("doc_id").cast("long").alias("__id"), *([F.unhex("text_sha256").alias("__sha")] if text_col else []))
    marked = docs.withColumn("__near", SlotFilter(keys, "__id").holds(id_col))
    some = marked.where("__near").drop("__near")
    match = F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
    if text_col:
        match = match & (F.unhex(F.sha2(text_or_empty(text_col), 256)) == F.col("__sha"))
    return keys, marked.where("NOT __near").drop("__near"), some, match


def without(docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text_col: str | None = "text") -> DataFrame:
    """``docs`` without those whose id and text digest are in ``rows`` (doc_id, text_sha256).

    Without a text column, ids alone tell. Most texts stay where they are; only
    those whose id may be named are shuffled, for an exact join.
    """
    keys, clear, some, match = _split(docs, rows, id_col, text_col)
    return clear.unionByName(some.join(keys, match, "left_anti"))


def matching(docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text_col: str | None = "text") -> DataFrame:
    """``docs`` whose id and text digest are in ``rows`` (doc_id, text_sha256)."""
    keys, _, some, match = _split(docs, rows, id_col, text_col)
    return some.join(keys, match, "left_semi")


def bounded(rows: DataFrame, most: int, *columns: str) -> DataFrame:
    """``rows`` where there are at most ``most``, else about as many, chosen by a hash of ``columns``."""
    count = rows.count()
    if count <= most:
        return rows
    share = max(0.0, most - 4 * most**0.5) / count
    return rows.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < int(share * (1 << 40)))
