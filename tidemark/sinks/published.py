"""Versioned Parquet tables.

A publish writes the touched buckets into a new version folder and then creates
one manifest file that says, for every bucket, which version folder holds it:

    <root>/__version=<uuid>/__bucket=2024-01-01/part-*.parquet
    <root>/manifests/00000003.json

The newest manifest is the table. Readers resolve it once, so they see one
whole version, also while the next one is being written; a job that dies
before its manifest leaves nothing visible. Buckets that were not touched are
not rewritten. The manifest grows with the number of buckets (days, months,
countries), never with the rows or files. It also is the lineage record of its
publish: rows, columns with their types, write time and the caller's extras.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog import Dataset
from tidemark.operators.merge import row_hash

META_SCHEMA = (
    "dataset STRING, version BIGINT, location STRING, row_count BIGINT, column_count INT, "
    "columns ARRAY<STRUCT<name: STRING, dtype: STRING>>, written_at TIMESTAMP, "
    "extra MAP<STRING, STRING>"
)
_NULL_BUCKET = "__HIVE_DEFAULT_PARTITION__"
# Reserved partition columns; no dataset may have columns of these names.
BUCKET, VERSION = "__bucket", "__version"


class ConcurrentPublish(RuntimeError):
    """Another writer published the same version first."""


@dataclass
class Manifest:
    version: int
    # Bucket folder name -> {"v": id of the version folder, "rows": row count, "compacted": bool,
    # "print": hash of the rows in any order, where the publish took one}
    buckets: dict[str, dict] = field(default_factory=dict)
    schema: T.StructType | None = None

    @property
    def rows(self) -> int:
        return sum(b["rows"] for b in self.buckets.values())

    def to_json(self, dataset: str, location: str, written_at: str, extra: dict) -> str:
        return json.dumps(
            {
                "dataset": dataset,
                "version": self.version,
                "location": location,
                "row_count": self.rows,
                "column_count": len(self.schema),
                "columns": [
                    {"name": f.name, "dtype": f.dataType.simpleString()} for f in self.schema
                ],
                "written_at": written_at,
                "extra": {k: str(v) for k, v in extra.items()},
                "schema": self.schema.jsonValue(),
                "buckets": self.buckets,
            }
        )


class PublishedTable:
    """A dataset in the store: read, stage, commit."""

    def __init__(self, spark: SparkSession, store: str, dataset: Dataset):
        self.spark = spark
        self.dataset = dataset
        self.store = store.rstrip("/")
        self.root = f"{self.store}/{dataset.name}"
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    # -- files ----------------------------------------------------------------

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self._conf)

    def _names(self, path: str) -> list[str]:
        fs, target = self._fs(), self._path(path)
        if not fs.exists(target):
            return []
        return [s.getPath().getName() for s in fs.listStatus(target)]

    def _manifest_versions(self) -> list[int]:
        names = self._names(f"{self.root}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:08d}.json"

    # -- reading --------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self._manifest_versions())

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or an older one by version; empty before the first publish."""
        versions = self._manifest_versions()
        if not versions:
            return Manifest(0, {}, self.dataset.schema)
        version = versions[-1] if version is None else version
        try:
            body = self._manifest_body(version)
        except ValueError:
            # The newest manifest is just being written: the one before is the table.
            if version != versions[-1] or len(versions) < 2:
                raise
            body = self._manifest_body(versions[-2])
        return Manifest(body["version"], body["buckets"], T.StructType.fromJson(body["schema"]))

    def extra(self) -> dict[str, str]:
        """What the caller said of the newest publish; nothing before the first."""
        versions = self._manifest_versions()
        return self._manifest_body(versions[-1])["extra"] if versions else {}

    def _manifest_body(self, version: int) -> dict:
        stream = self._fs().open(self._path(self._manifest_path(version)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(
        self,
        version: int | None = None,
        keep: Callable[[str], bool] | None = None,
        manifest: Manifest | None = None,
        with_bucket: bool = False,
    ) -> DataFrame:
        """The table, or the buckets ``keep`` accepts; other buckets are not even listed.

        ``with_bucket`` adds each row's bucket as ``__bucket``.
        """
        manifest = manifest or self.manifest(version)
        folders = [
            f"{self.root}/{VERSION}={entry['v']}/{name}"
            for name, entry in manifest.buckets.items()
            if keep is None or keep(bucket_value(name))
        ]
        schema = manifest.schema
        if not folders:
            df = self.spark.createDataFrame([], schema)
            return df.withColumn(BUCKET, F.lit(None).cast("string")) if with_bucket else df
        stored = T.StructType(
            list(schema) + [T.StructField(VERSION, T.StringType()), T.StructField(BUCKET, T.StringType())]
        )
        df = self.spark.read.schema(stored).option("basePath", self.root).parquet(*folders)
        return df.drop(VERSION) if with_bucket else df.drop(VERSION, BUCKET)

    def read_key(self, key: str) -> DataFrame:
        """Rows of one ticker, country, market or underlying; the key is case-normalised.

        A table bucketed by that column reads one bucket. In the others the
        equality is pushed down to files sorted by it.
        """
        key, column = key.upper(), self.dataset.item_column
        if column is None:
            raise ValueError(f"{self.dataset.name} is not kept by ticker, country or market")
        if self.dataset.bucket_column == column:
            return self.read(keep=lambda bucket: bucket is not None and bucket.upper() == key)
        return self.read().where(F.col(column) == F.lit(key))

    def read_dates(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """Rows from ``start`` to ``end``, both included; only buckets in reach are read."""
        date = F.col(self.dataset.date_column)
        keep = self._date_filter(start, end) if self.dataset.time_bucketed else None
        df = self.read(keep=keep)
        if start is not None:
            df = df.where(date >= F.lit(start))
        return df if end is None else df.where(date <= F.lit(end))

    def _date_filter(self, start, end) -> Callable[[str], bool]:
        width = self.dataset.bucket_width
        low = None if start is None else bucket_start(width, start)

        def keep(bucket: str | None) -> bool:
            if bucket is None:
                return False
            day = dt.date.fromisoformat(bucket)
            return (low is None or day >= low) and (end is None or day <= end)

        return keep

    def max_date(self) -> dt.date | None:
        """Latest date, read from the newest bucket alone where buckets are periods."""
        column = self.dataset.date_column
        if self.dataset.time_bucketed:
            values = [bucket_value(n) for n in self.manifest().buckets]
            days = [v for v in values if v is not None]
            if not days:
                return None
            newest = max(days)
            return self.read(keep=lambda b: b == newest).agg(F.max(column)).first()[0]
        return self.read().agg(F.max(column)).first()[0]

    # -- writing --------------------------------------------------------------

    def stage(
        self,
        df: DataFrame,
        order: Iterable[str] | None = None,
        dense: bool = False,
    ) -> str:
        """Write rows into a new version folder; nothing is visible until ``commit``.

        The folder's name is drawn anew, so writers never share one.

        The rebalance puts the rows of a bucket together, splits large buckets
        over many tasks and joins small ones, so neither a hot bucket nor many
        tiny files arise. ``dense`` range-partitions by bucket and sort order
        instead, for tables that are compacted.
        """
        clash = {BUCKET, VERSION} & set(df.columns)
        if clash:
            raise ValueError(f"{self.dataset.name}: reserved column names: {sorted(clash)}")
        folder = uuid.uuid4().hex
        sort = list(order or self.dataset.sort_columns)
        sort_by = [_ordering(c) for c in sort]
        out = df.withColumn(BUCKET, self.dataset.bucket_expr())
        if dense:
            out = out.repartitionByRange(F.col(BUCKET), *sort_by)
        else:
            out = out.hint("rebalance", F.col(BUCKET))
        out = out.sortWithinPartitions(F.col(BUCKET), *sort_by)
        writer = out.write.partitionBy(BUCKET).option("compression", "zstd")
        for column in self.dataset.bloom_columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.mode("errorifexists").parquet(f"{self.root}/{VERSION}={folder}")
        return folder

    def staged(self, folder: str, schema: T.StructType) -> DataFrame:
        """Rows of a staged folder, with their bucket as ``__bucket``."""
        stored = T.StructType(list(schema) + [T.StructField(BUCKET, T.StringType())])
        return self.spark.read.schema(stored).parquet(f"{self.root}/{VERSION}={folder}")

    def staged_names(self, folder: str) -> list[str]:
        """Bucket folders of a staged folder."""
        return [n for n in self._names(f"{self.root}/{VERSION}={folder}") if n.startswith(f"{BUCKET}=")]

    def staged_counts(self, folder: str, schema: T.StructType) -> dict[str, int]:
        """Rows per bucket of what was written, read back from the files.

        Counters kept during the write could count a task twice when an
        executor is lost; the files cannot. One row per bucket is collected.
        """
        rows = self.staged(folder, schema).groupBy(BUCKET).count().collect()
        return {bucket_folder(r[BUCKET]): r["count"] for r in rows}

    def staged_prints(self, folder: str, schema: T.StructType) -> dict[str, tuple[int, str]]:
        """``staged_counts`` with a hash of each bucket's rows, in any order, from the same read."""
        staged = self.staged(folder, schema)
        hashed = staged.select(BUCKET, row_hash(staged.drop(BUCKET)).alias("h"))
        # The sum of the upper bits tells rows apart that cancel out in the other.
        both = F.concat_ws(".", F.hex(F.bit_xor("h")), F.sum(F.shiftrightunsigned("h", 40)).cast("string"))
        rows = hashed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), both.alias("print")).collect()
        return {bucket_folder(r[BUCKET]): (r["n"], r["print"]) for r in rows}

    def commit(
        self,
        base: Manifest,
        folder: str | None,
        counts: dict[str, int],
        schema: T.StructType,
        drop: Iterable[str] = (),
        replace_all: bool = False,
        compacted: bool = False,
        extra: dict[str, str] | None = None,
        prints: dict[str, str] | None = None,
    ) -> Manifest:
        """Publish a staged folder on top of ``base`` and record its lineage.

        With ``prints``, a bucket whose rows are those of ``base`` keeps its
        files there, so that readers of the manifests see no change.
        """
        prints = prints or {}
        same_schema = base.schema == schema
        buckets = {} if replace_all else dict(base.buckets)
        for name in drop:
            buckets.pop(name, None)
        for name, rows in counts.items():
            old = base.buckets.get(name, {})
            mark = old.get("print") if compacted else prints.get(name)
            if mark and not compacted and same_schema and (old.get("print"), old.get("rows")) == (mark, rows):
                buckets[name] = old
                continue
            buckets[name] = {"v": folder, "rows": rows, "compacted": compacted}
            if mark:
                buckets[name]["print"] = mark
        merged = Manifest(base.version + 1, buckets, schema)
        self._write_manifest(merged, extra or {})
        return merged

    def _write_manifest(self, manifest: Manifest, extra: dict) -> None:
        fs = self._fs()
        written_at = dt.datetime.now(dt.timezone.utc).isoformat()
        text = manifest.to_json(self.dataset.name, self.root, written_at, extra)
        target = self._path(self._manifest_path(manifest.version))
        # Creating the file without overwriting is the commit: of two writers one is refused.
        try:
            stream = fs.create(target, False)
        except Py4JJavaError as error:
            if not fs.exists(target):
                raise
            raise ConcurrentPublish(
                f"{self.root}: version {manifest.version} was published already"
            ) from error
        stream.write(bytearray(text, "utf-8"))
        stream.close()

    def replace(self, df: DataFrame, extra: dict[str, str] | None = None) -> Manifest:
        """Replace the whole table: all or nothing."""
        base = self.manifest()
        folder = self.stage(df)
        counts = self.staged_counts(folder, df.schema)
        return self.commit(base, folder, counts, df.schema, replace_all=True, extra=extra)

    # -- upkeep ---------------------------------------------------------------

    def expire_versions(self, keep: int = 2, hours: float = 24.0) -> list[str]:
        """Delete version folders that the last ``keep`` manifests do not use.

        Folders younger than ``hours`` may belong to a running job and stay.
        Manifests stay too: they are the lineage.
        """
        versions = self._manifest_versions()
        recent = [self.manifest(v) for v in versions[-keep:]]
        used = {b["v"] for m in recent for b in m.buckets.values()}
        fs, gone = self._fs(), []
        limit = (dt.datetime.now(dt.timezone.utc).timestamp() - hours * 3600) * 1000
        for name in self._names(self.root):
            path = self._path(f"{self.root}/{name}")
            folder = name.removeprefix(f"{VERSION}=")
            if folder == name or folder in used or fs.getFileStatus(path).getModificationTime() > limit:
                continue
            fs.delete(path, True)
            gone.append(folder)
        return sorted(gone)


def read_lineage(spark: SparkSession, store: str, names: Iterable[str] | None = None) -> DataFrame:
    """The lineage table: one row per publish of every dataset of a store, or of the named ones."""
    folders = ["*"] if names is None else list(names)
    return spark.read.schema(META_SCHEMA).json([f"{store.rstrip('/')}/{n}/manifests/*.json" for n in folders])


def bucket_start(width: str, day: dt.date) -> dt.date:
    """First day of the bucket of a date."""
    if width == "day":
        return day
    if width == "month":
        return day.replace(day=1)
    if width == "quarter":
        return day.replace(month=(day.month - 1) // 3 * 3 + 1, day=1)
    return day.replace(month=1, day=1)


def _ordering(column: str):
    name, _, direction = column.partition(" ")
    return F.col(name).desc() if direction.upper() == "DESC" else F.col(name).asc()


def bucket_value(folder: str) -> str | None:
    from urllib.parse import unquote

    value = unquote(folder.split("=", 1)[1])
    return None if value == _NULL_BUCKET else value


def bucket_day(folder: str) -> dt.date | None:
    """First day of a bucket of time; null for the rows without a date."""
    value = bucket_value(folder)
    return None if value is None else dt.date.fromisoformat(value)


def bucket_folder(bucket: str | None) -> str:
    """Folder name of a bucket value, with the escapes Spark uses for partitions."""
    if bucket is None or bucket == "":
        return f"{BUCKET}={_NULL_BUCKET}"
    special = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(32)}
    return f"{BUCKET}=" + "".join(f"%{ord(c):02X}" if c in special else c for c in bucket)
