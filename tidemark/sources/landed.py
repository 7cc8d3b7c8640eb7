"""Landed payloads: one row per payload, with the symbol it belongs to.

Every reader takes a DataFrame with ``symbol`` and ``raw`` (the payload text).
A payload that cannot be parsed does not stop the others: each reader has a
``*_problem`` column rule, and ``quarantine`` lists the payloads it rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.union import relaxed_union


def read_landed(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Payload files to ``symbol, raw``; the symbol is the file name without its ending.

    ``one_per_line`` reads files that hold one payload per line and carry the
    symbol inside the payload.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=not one_per_line)
    file_name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[A-Za-z]+)?$", 1)
    return text.select(file_name.alias("symbol"), F.col("value").alias("raw"))


def placed(text: DataFrame) -> DataFrame:
    """Text rows with where they lie: ``raw``, ``file``, ``block`` (first byte of the file block), ``row``."""
    return text.select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``read_landed`` of whole files, with where they lie."""
    files = placed(spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True))
    return files.withColumn("symbol", F.regexp_extract("file", r"([^/]+?)(\.[A-Za-z]+)?$", 1))


def read_lines(spark: SparkSession, path: str, *envelope: str) -> DataFrame:
    """JSON lines with where they lie, next to the envelope fields they carry."""
    fields = F.from_json("raw", ", ".join(f"{e} STRING" for e in envelope))
    return placed(spark.read.text(path)).withColumn("__envelope", fields).select("*", "__envelope.*").drop("__envelope")


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """The first line with text of each file: ``header, file``.

    Files are read as lines and may be split; no task holds a file. Where a
    first line stands is one hash aggregate over row numbers of the files'
    first blocks, so no line is sorted.
    """
    lines = placed(spark.read.text(path)).where("block = 0")
    first = lines.where(F.trim("raw") != "").groupBy("file").agg(F.min("row").alias("row"))
    return lines.join(first, ["file", "row"]).select(F.col("raw").alias("header"), "file")


def read_landed_table(
    spark: SparkSession, path: str, schema: str | None = None, sep: str = ","
) -> DataFrame:
    """Delimited landed files with a header; columns stay text unless a schema is given.

    Files may differ in which columns they have and in their order: those with
    the same header line are read together, and the groups are united by name.
    Paths come to the driver, which lists them anyway, only where headers differ.
    """
    reader = spark.read.option("header", "true").option("sep", sep)
    heads = header_lines(spark, path)
    if heads.agg(F.min("header") == F.max("header")).first()[0] is not False:
        return (reader.schema(schema) if schema else reader).csv(path)
    groups: dict[str, list[str]] = {}
    for row in heads.orderBy("header", "file").toLocalIterator():
        groups.setdefault(row["header"], []).append(row["file"])
    read = relaxed_union(*[reader.csv(paths) for paths in groups.values()])
    if schema is None:
        return read
    wanted = T.StructType.fromDDL(schema)
    return read.select(*[
        (F.col(f"`{f.name}`") if f.name in read.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in wanted
    ])


def is_broken_json(raw: Column) -> Column:
    """True for text that is no JSON object."""
    return F.from_json(raw, "map<string,string>").isNull()


def error_payload(raw: Column) -> Column:
    """The error text a vendor sends in place of data, else null."""
    return F.coalesce(
        F.get_json_object(raw, "$['Error Message']"),
        F.get_json_object(raw, "$.Note"),
        F.get_json_object(raw, "$.Information"),
    )


def quarantine(landed: DataFrame, problem: Column) -> DataFrame:
    """Payloads with a problem: symbol, reason, raw."""
    return (
        landed.withColumn("reason", problem)
        .where(F.col("reason").isNotNull())
        .select("symbol", "reason", "raw")
    )
