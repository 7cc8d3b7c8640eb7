"""Registered queries and the table adapters they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Fetch time of every batch in these queries.
BATCH_TS = "2024-06-01 00:00:00"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its SQL where there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100)


def shown(df: DataFrame) -> DataFrame:
    """Dates as ISO text, decimals as doubles."""
    changes = {}
    for f in df.schema:
        if isinstance(f.dataType, T.DateType):
            changes[f.name] = F.col(f"`{f.name}`").cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            changes[f.name] = F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            changes[f.name] = F.col(f"`{f.name}`").cast("double")
    return df.withColumns(changes) if changes else df


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bars: priority is the ticker; the order key breaks ties on a day."""
    price = cents("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("ticker"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderkey").alias("seq"),
        *[price.alias(c) for c in ("open", "high", "low", "close", "vwap")],
        F.col("o_custkey").cast("double").alias("volume"),
    )


BARS_SQL = """
    SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date, o_orderkey AS seq,
           round(o_totalprice * 100) AS price, CAST(o_custkey AS DOUBLE) AS volume
    FROM orders"""


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as series: the event type is the label."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_label"),
        F.col("ts").cast("date").alias("date"),
        F.col("ts").alias("ts"),
        F.col("event_id"),
        F.col("user_id"),
        cents("value").alias("value"),
    )
