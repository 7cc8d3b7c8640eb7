"""Stored files: reading, conversion, listing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.union import relaxed_union


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table. An absent path is an empty table; an unreadable file is an error."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_all(spark: SparkSession, groups: Iterable[str | list[str]], **options) -> DataFrame:
    """Relaxed union of files or folders whose columns or types differ.

    Each entry is one schema group (a folder, or a list of files) and is read
    in one scan; only groups are united.
    """
    frames = []
    for group in groups:
        paths = [group] if isinstance(group, str) else list(group)
        frames.append(spark.read.options(**options).option("mergeSchema", "true").parquet(*paths))
    return relaxed_union(*frames)


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    file_type: str = "csv",
    sep: str = ",",
    schema: T.StructType | str | None = None,
) -> None:
    """Delimited text with a header to zstd Parquet. Other file types are refused.

    Without a schema the types are inferred, which reads the text twice.
    """
    if file_type not in ("txt", "csv"):
        raise ValueError(f"file type not supported: {file_type!r}")
    reader = spark.read.option("header", "true").option("sep", sep)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    reader.csv(source).write.option("compression", "zstd").parquet(target)


_LISTING_SCHEMA = "path STRING, bytes BIGINT, modified TIMESTAMP, rows BIGINT, columns INT, reason STRING"


def _footer_counts(path: str) -> tuple[int | None, int | None, str | None]:
    """(rows, columns, None) from a file's footer, or the reason why it cannot be read in place of counts."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    # Hadoop writes local paths with a single slash.
    uri = "file:///" + path[len("file:") :].lstrip("/") if path.startswith("file:") else path
    try:
        fs, inner = pafs.FileSystem.from_uri(uri)
        with fs.open_input_file(inner) as handle:
            meta = pq.read_metadata(handle)
            return meta.num_rows, len(meta.schema.to_arrow_schema()), None
    except (OSError, ValueError, NotImplementedError) as fault:  # Arrow's own errors are of these kinds
        return None, None, f"{type(fault).__name__}: {fault}"


def _add_footers(batches: Iterator) -> Iterator:
    for frame in batches:
        counts = [_footer_counts(path) for path in frame["path"]]
        frame["rows"] = [rows for rows, _, _ in counts]
        frame["columns"] = [columns for _, columns, _ in counts]
        frame["reason"] = [reason for _, _, reason in counts]
        yield frame.astype({"rows": "Int64", "columns": "Int32"})


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet file under ``root``: path, size, modified time, rows, columns, reason.

    Only footers are read, inside the tasks. A file that cannot be read has
    null counts and the reason; a readable one has no reason.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    )
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    prefix = F.lit("^([a-z0-9]+:)?/*\\Q" + base + "\\E/")
    return listing.mapInPandas(_add_footers, _LISTING_SCHEMA).withColumn(
        "relative_path", F.regexp_replace(F.col("path"), prefix, F.lit(""))
    )


def file_info(spark: SparkSession, path: str) -> DataFrame:
    """One row: path, files, bytes, last change, rows, columns, estimated memory."""
    df = spark.read.parquet(path)
    memory = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    sizes = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("modified"),
        )
    )
    return sizes.select(
        F.lit(path).alias("path"),
        "files",
        "bytes",
        "modified",
        F.lit(df.count()).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.lit(int(str(memory))).cast("bigint").alias("memory_bytes"),
    )
