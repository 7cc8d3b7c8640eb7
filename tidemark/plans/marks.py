"""High-water marks: the newest date of every item of a dataset, kept beside it.

Marks are a small published table that says which version of the dataset it was
taken from. An increment reads them in place of the stored rows. Where they are
of another version (another kind of save, upkeep, or a job that died between
its two commits), they are taken from the stored rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import Dataset, table_schema
from tidemark.sinks.published import Manifest, PublishedTable


def marks_table(table: PublishedTable) -> PublishedTable:
    marks = Dataset(
        table.dataset.name, table_schema("item STRING", "newest DATE"), keys=("item",),
        date_column=None, bucket_width=None, cluster_by=("item",),
    )
    return PublishedTable(table.spark, f"{table.store}/_marks", marks)


def _newest(rows: DataFrame, dataset: Dataset) -> DataFrame:
    newest = F.max(F.col(dataset.date_column)).cast("date").alias("newest")
    return rows.groupBy(F.col(dataset.item_column).alias("item")).agg(newest)


def read_marks(table: PublishedTable, base: Manifest) -> DataFrame:
    """(item, newest) of a version of a dataset."""
    marks = marks_table(table)
    if marks.exists() and marks.extra().get("of") == str(base.version):
        return marks.read()
    return _newest(table.read(manifest=base), table.dataset)


def move_marks(table: PublishedTable, base: Manifest, done: Manifest, batch: DataFrame) -> None:
    """Marks of the version ``done``, which merged ``batch`` into ``base``."""
    both = read_marks(table, base).unionByName(_newest(batch, table.dataset))
    marks_table(table).replace(both.groupBy("item").agg(F.max("newest").alias("newest")), extra={"of": done.version})


def as_stored(marks: DataFrame, dataset: Dataset) -> DataFrame:
    """Marks under the column names of the dataset, as rows that start dates can be taken from."""
    return marks.select(F.col("item").alias(dataset.item_column), F.col("newest").alias(dataset.date_column))
