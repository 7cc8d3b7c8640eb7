"""Keep-latest merge, grain dedupe and upsert."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.union import align, merged_schema, relaxed_union

_IS_NEW = "__is_new"
_RANK = "__rank"
_TIE = "__tie"


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return isinstance(t, T.StructType) and any(_has_map(f.dataType) for f in t)


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row; the last tie-breaker, so results never depend on partitioning or column order."""
    parts = []
    for f in sorted(df.schema, key=lambda f: f.name):
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType):
            column = F.to_json(F.array_sort(F.map_entries(column)))
        elif _has_map(f.dataType):
            column = F.to_json(column)
        parts.append(column)
    return F.xxhash64(*parts)


def keep_first(df: DataFrame, keys: Iterable[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    The rank filter lets Spark cut every key to one row per map task before
    the shuffle (WindowGroupLimit), so a key with a third of all rows never
    lands in one task.
    """
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def merge_latest(
    existing: DataFrame,
    new: DataFrame,
    keys: Iterable[str],
    fetched_at: str = "last_fetched_at",
) -> DataFrame:
    """Relaxed union that keeps, per key, the row fetched last.

    On equal fetch times the new batch wins, then the hash that the row has in
    its own table, before the union changes types or adds columns. So a batch's
    ties are settled as ``dedupe_grain`` of the batch settles them.
    """
    both = relaxed_union(
        existing.withColumns({_IS_NEW: F.lit(0), _TIE: row_hash(existing)}),
        new.withColumns({_IS_NEW: F.lit(1), _TIE: row_hash(new)}),
    )
    order = [F.col(_IS_NEW).desc(), F.col(_TIE).desc()]
    if fetched_at in both.columns:
        order.insert(0, F.col(fetched_at).desc_nulls_last())
    return keep_first(both, keys, order).drop(_IS_NEW, _TIE)


def dedupe_grain(
    df: DataFrame, keys: Iterable[str], fetched_at: str = "last_fetched_at"
) -> DataFrame:
    """One row per key, the one fetched last."""
    order = [row_hash(df).desc()]
    if fetched_at in df.columns:
        order.insert(0, F.col(fetched_at).desc_nulls_last())
    return keep_first(df, keys, order)


def upsert(existing: DataFrame, new: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Insert new keys and update known ones.

    Columns that ``new`` does not carry keep their old values. When it carries
    none besides the keys, known rows stay as they are.
    """
    keys = list(keys)
    new = dedupe_grain(new, keys)
    supplied = [c for c in new.columns if c not in keys]
    target = merged_schema(existing.schema, new.schema)
    if not supplied:
        added = new.join(existing.select(*keys), keys, "left_anti")
        return relaxed_union(existing, added)
    kept = [c for c in existing.columns if c not in keys and c not in supplied]
    if not kept:
        untouched = existing.join(new.select(*keys), keys, "left_anti")
        return align(relaxed_union(untouched, new), target)
    # Keys are unique on both sides, so no task can get more than its share.
    renamed = {c: f"__new_{c}" for c in supplied}
    updates = new.withColumnsRenamed(renamed).withColumn(_IS_NEW, F.lit(1))
    joined = existing.join(updates, keys, "full_outer")
    have = set(existing.columns)
    out = []
    for f in target:
        if f.name in renamed:
            old = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
            fresh = F.col(f"`{renamed[f.name]}`").cast(f.dataType)
            value = F.when(F.col(_IS_NEW) == 1, fresh).otherwise(old.cast(f.dataType))
        else:
            value = F.col(f"`{f.name}`").cast(f.dataType)
        out.append(value.alias(f.name))
    return joined.select(*out)
