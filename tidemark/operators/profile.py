"""Dataset profiles as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import percent
from tidemark.operators.limits import head

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType)


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, nulls, non-nulls and null percentage (0 when there are no rows)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(_name(c)).alias(c) for c in df.columns]
    )
    types = dict(df.dtypes)
    rows = F.col("__rows")
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            (rows - _name(c)).alias("null_count"),
            _name(c).alias("non_null_count"),
            percent(rows - _name(c), rows).alias("null_percent"),
        )
        for i, c in enumerate(df.columns, 1)
    ]
    return counts.select(F.inline(F.array(*cells)))


def _comparable(t: T.DataType) -> bool:
    return not isinstance(t, (T.MapType, T.ArrayType, T.StructType, T.VariantType))


def _plain(f: T.StructField) -> Column:
    """A column in a form whose equal values hash alike."""
    column = _name(f.name)
    if not _comparable(f.dataType):
        return F.when(column.isNotNull(), F.to_json(F.struct(column)))
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return column + F.lit(0.0)  # -0.0 is 0.0
    return column


def _uniques(df: DataFrame) -> DataFrame:
    """One row: a map of column position to its number of different values.

    What is shuffled is a pair of hashes for each value and column, formed and
    made distinct before the shuffle, never the values themselves.
    """
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.xxhash64(_plain(f)).alias("h1"),
            F.xxhash64(F.lit("second"), _plain(f)).alias("h2"),
            _name(f.name).isNotNull().alias("filled"),
        )
        for i, f in enumerate(df.schema, 1)
    ]
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where("filled")
    counts = long.groupBy("position", "h1", "h2").agg(F.first("filled")).groupBy("position").count()
    return counts.agg(F.map_from_entries(F.collect_list(F.struct("position", "count"))).alias("uniques"))


def _range(f: T.StructField) -> tuple[Column, Column, Column]:
    """(min, max, mean) of a column as text; which of them exist depends on the type."""
    column, t = _name(f.name), f.dataType
    if isinstance(t, T.NumericType):
        low, high, mean = F.min(column), F.max(column), F.avg(column)
    elif isinstance(t, _TEMPORAL):
        low, high, mean = F.min(column), F.max(column), F.lit(None)
    elif isinstance(t, T.BooleanType):
        share = F.count_if(column) * 100.0 / F.nullif(F.count(column), F.lit(0))
        low, high, mean = F.lit(None), F.lit(None), share
    elif isinstance(t, T.StringType):
        low, high, mean = F.min(F.char_length(column)), F.max(F.char_length(column)), F.lit(None)
    else:
        low = high = mean = F.lit(None)
    return low, high, mean


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "value"
    if isinstance(t, _TEMPORAL):
        return "time"
    if isinstance(t, T.BooleanType):
        return "percent_true"
    if isinstance(t, T.StringType):
        return "length"
    return "none"


def _column_cell(position: int, f: T.StructField, approximate: bool) -> Column:
    """The statistics of one column out of the row of aggregates."""
    at = lambda what: F.col(f"`{what}:{position}`")
    nulls = F.col("`:rows`") - at("filled")
    found = at("distinct") if approximate else F.coalesce(F.col("uniques")[position], F.lit(0))
    timed = _kind(f.dataType) == "time"
    number, moment = F.lit(None).cast("double"), F.lit(None).cast("string")
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(f.name).alias("column"),
        F.lit(f.dataType.simpleString()).alias("type"),
        F.lit(_kind(f.dataType)).alias("kind"),
        nulls.alias("nulls"),
        (found + (nulls > 0).cast("bigint")).alias("uniques"),
        (number if timed else at("low").cast("double")).alias("min_number"),
        (number if timed else at("high").cast("double")).alias("max_number"),
        (number if timed else at("mean").cast("double")).alias("mean_number"),
        (at("low").cast("string") if timed else moment).alias("min_time"),
        (at("high").cast("string") if timed else moment).alias("max_time"),
    )


def column_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: nulls, uniques (null counts as one value) and the typed range.

    Numbers report min, max and mean, dates and times min and max, flags the
    percentage of true, text the shortest and longest length in characters;
    ``kind`` says which. Numeric results are in ``*_number``, times in
    ``*_time``. ``approximate`` trades exact unique counts for a sketch that
    needs no shuffle at all.

    All ranges come from one aggregate over one scan, the unique counts from a
    second scan whose values are hashed to 128 bits before they are shuffled.
    """
    fields = list(enumerate(df.schema, 1))
    aggregates = [F.count(F.lit(1)).alias(":rows")]
    for i, f in fields:
        low, high, mean = _range(f)
        aggregates += [
            F.count(_name(f.name)).alias(f"filled:{i}"), low.alias(f"low:{i}"), high.alias(f"high:{i}"), mean.alias(f"mean:{i}")
        ]
        if approximate:
            aggregates.append(F.approx_count_distinct(_plain(f)).alias(f"distinct:{i}"))
    one = df.agg(*aggregates)
    if not approximate:
        one = one.crossJoin(_uniques(df))  # one row by one row
    return one.select(F.inline(F.array(*[_column_cell(i, f, approximate) for i, f in fields])))


def numeric_summary(df: DataFrame) -> DataFrame:
    """Numeric columns: min, max, mean and sample standard deviation."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if not numeric:
        schema = "column STRING, min DOUBLE, max DOUBLE, mean DOUBLE, std DOUBLE"
        return df.sparkSession.createDataFrame([], schema)
    stats = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}
    one = df.agg(
        *[fn(_name(c)).cast("double").alias(f"{s}:{c}") for c in numeric for s, fn in stats.items()]
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"), *[F.col(f"`{s}:{c}`").alias(s) for s in stats]
        )
        for c in numeric
    ]
    return one.select(F.inline(F.array(*cells)))


def dataset_summary(df: DataFrame, preview_keys: list[str], n: int = 10) -> dict[str, DataFrame]:
    """Header, column overview, first rows and numeric summary, as lazy DataFrames."""
    header = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
    overview = column_stats(df).select("position", "column", "type", "nulls", "uniques")
    return {
        "header": header,
        "overview": overview,
        "preview": head(df, n, *preview_keys),
        "numeric": numeric_summary(df),
    }
