"""Mixing sources to target weights by hash-seeded Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most sources whose rates are sent to every task; more are joined by a shuffle.
BROADCAST_SOURCES = 20_000
#: Largest mean of one draw; e**-mean must stay a normal double. Larger means are sums of several draws.
MAX_RATE = 500.0
#: Most copies of a row that are numbered in one array.
CHUNK = 4096


def uniform(seed: str, *columns: str) -> Column:
    """A number in [0, 1) fixed by the seed and the columns: 52 bits of their MD5."""
    parts = [F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(
    docs: DataFrame, source_col: str, weights: dict[str, float] | None = None, exponent: float = 0.5, epochs: float = 1.0
) -> DataFrame:
    """(source, rate): mean repetitions that give each source its share of ``epochs`` times the input.

    A source's share is its weight over the sum of weights; without ``weights``
    it goes by the number of documents to the power ``exponent``, so large
    sources are thinned and small ones repeated. A source without a weight has
    rate 0. Rows without a source form a source of their own.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(exponent))
    else:
        shares = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weight = F.coalesce(shares[F.col("source")].cast("double"), F.lit(0.0))
    weighed = sizes.withColumn("weight", weight)
    total = weighed.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights")).first()
    rows, all_weights = total["rows"] or 0, total["weights"] or 1.0
    rate = F.col("weight") * F.lit(float(epochs * rows)) / F.lit(float(all_weights)) / F.col("n")
    return weighed.select("source", F.when(F.col("weight") > 0, rate).otherwise(0.0).alias("rate"))


def poisson(u: Column, steps: Column) -> Column:
    """The Poisson number whose distribution function first exceeds ``u``, given its first values."""
    return F.size(F.filter(steps, lambda below: below <= u))


def _steps(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until it is 1 in doubles, or so close that no 52-bit number lies above."""
    term, total, found, k = math.exp(-rate), 0.0, [], 0
    while k <= rate or term > 1e-18:
        total += term
        found.append(min(total, 1.0))
        k += 1
        term *= rate / k
    return found


def _draws(rate: float) -> int:
    """How many independent draws add up to one with mean ``rate``."""
    return max(1, math.ceil(rate / MAX_RATE))


def _copies(seed: str, id_col: str) -> Column:
    """The sum of ``__draws`` Poisson numbers with the same ``__steps``, each from a hash of its own."""

    def further(k: Column) -> Column:
        parts = F.concat_ws(":", F.lit(seed), F.lit("draw"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), k)
        u = F.conv(F.substring(F.md5(parts), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
        return poisson(u, F.col("__steps"))

    first = poisson(uniform(seed, id_col), F.col("__steps"))
    others = F.aggregate(F.sequence(F.lit(2), F.col("__draws")), first, lambda total, k: total + further(k))
    return F.when(F.col("__draws") > 1, others).otherwise(first)


def replicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: dict[str, float] | None = None,
    exponent: float = 0.5,
    epochs: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """Every row repeated as often as its own Poisson draw says, in a global random order.

    Adds ``copy`` (from 0) and ``shuffle_key``, by which the result is sorted
    over all partitions. The draw depends on seed and id only: runs agree, and
    rows with the same id are repeated alike. With the method's draws a row can
    come zero times; over a source the repetitions meet the rate, however large
    it is. An empty table gives no rows; texts of any kind are carried along.
    """
    found = rates(docs, source_col, weights, exponent, epochs)
    small = found.limit(BROADCAST_SOURCES + 1).collect()
    schema = T.StructType([
        T.StructField("__source", T.StringType()), T.StructField("__draws", T.IntegerType()),
        T.StructField("__steps", T.ArrayType(T.DoubleType())),
    ])

    def drawn_by(rate: float) -> tuple[int, list[float]]:
        return _draws(rate), _steps(rate / _draws(rate))

    source = F.col(source_col).cast("string")
    if len(small) <= BROADCAST_SOURCES:
        table = docs.sparkSession.createDataFrame([(r["source"], *drawn_by(r["rate"])) for r in small], schema)
        table = F.broadcast(table)
    else:
        drawn_of = F.udf(drawn_by, T.StructType(schema.fields[1:]))
        table = found.select(F.col("source").alias("__source"), drawn_of("rate").alias("__by")).select("__source", "__by.*")
    drawn = docs.join(table, source.eqNullSafe(F.col("__source")))
    counted = drawn.withColumn("__copies", _copies(seed, id_col)).where("__copies > 0").drop("__source", "__draws", "__steps")
    last = F.col("__copies") - 1
    chunks = counted.withColumn("__from", F.explode(F.sequence(F.lit(0), last, F.lit(CHUNK))))
    numbers = F.sequence(F.col("__from"), F.least(last, F.col("__from") + (CHUNK - 1)))
    each = chunks.withColumn("copy", F.explode(numbers)).drop("__copies", "__from")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.col(id_col), F.col("copy")))
    return each.withColumn("shuffle_key", key).orderBy("shuffle_key")
