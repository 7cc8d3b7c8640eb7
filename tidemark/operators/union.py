"""Union by name with type widening decided from the schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_FLOATING = (T.FloatType, T.DoubleType)
_TEMPORAL = (T.DateType, T.TimestampNTZType, T.TimestampType)


def _rank(order: tuple, t: T.DataType) -> int:
    return next(i for i, cls in enumerate(order) if isinstance(t, cls))


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """Smallest type both fit: integers < decimals < doubles < text, date < timestamp.

    Numbers meeting text become text, so no value is lost to a failed cast.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = supertype(a.elementType, b.elementType)
        return T.ArrayType(inner, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(
            supertype(a.keyType, b.keyType), supertype(a.valueType, b.valueType), True
        )
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _struct_supertype(a, b)
    if isinstance(a, T.BooleanType) and isinstance(b, T.NumericType):
        return b
    if isinstance(b, T.BooleanType) and isinstance(a, T.NumericType):
        return a
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _number_supertype(a, b)
    if isinstance(a, _TEMPORAL) and isinstance(b, _TEMPORAL):
        return max(a, b, key=lambda t: _rank(_TEMPORAL, t))
    return T.StringType()


def _struct_supertype(a: T.StructType, b: T.StructType) -> T.StructType:
    right = {f.name: f.dataType for f in b}
    fields = [
        T.StructField(f.name, supertype(f.dataType, right.get(f.name, T.NullType()))) for f in a
    ]
    known = {f.name for f in a}
    return T.StructType(fields + [f for f in b if f.name not in known])


def _number_supertype(a: T.NumericType, b: T.NumericType) -> T.DataType:
    if isinstance(a, _FLOATING) or isinstance(b, _FLOATING):
        both_float = isinstance(a, T.FloatType) and isinstance(b, T.FloatType)
        return T.FloatType() if both_float else T.DoubleType()
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return max(a, b, key=lambda t: _rank(_INTEGRAL, t))
    left, right = _as_decimal(a), _as_decimal(b)
    scale = max(left.scale, right.scale)
    whole = max(left.precision - left.scale, right.precision - right.scale)
    return T.DecimalType(min(38, whole + scale), scale)


def _as_decimal(t: T.NumericType) -> T.DecimalType:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_INTEGRAL_DIGITS[type(t)], 0)


def merged_schema(*schemas: T.StructType) -> T.StructType:
    """Columns in order of first appearance, each with the common supertype."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            types[f.name] = supertype(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; missing ones are null."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (
                F.lit(None).cast(f.dataType).alias(f.name)
                if f.name not in have
                else (
                    F.col(f"`{f.name}`")
                    if have[f.name] == f.dataType
                    else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                )
            )
            for f in schema
        ]
    )


def relaxed_union(*frames: DataFrame) -> DataFrame:
    """Union all by name: missing columns become null, types widen to the supertype."""
    if not frames:
        raise ValueError("relaxed_union needs at least one DataFrame")
    target = merged_schema(*[f.schema for f in frames])
    return reduce(DataFrame.union, [align(f, target) for f in frames])
