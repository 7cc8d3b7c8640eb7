"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **extra) -> SparkSession:
    """A session with the settings the library assumes; ``extra`` keys win.

    Keys of ``extra`` are written with ``__`` for ``.``, as in
    ``spark__sql__shuffle__partitions=8``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**_SETTINGS, **{k.replace("__", "."): str(v) for k, v in extra.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession, label: str) -> str:
    """A fresh folder under the folder that driver and executors share.

    ``spark.checkpoint.dir`` names it. Where it is unset and the session runs
    on this machine alone, a temporary folder is set for the session; on a
    cluster that would lose data, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
