"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Suggested for a cluster session; a session that already exists keeps its own.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

_local_root: str | None = None
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def build(master: str | None = None, app: str = "gridloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Calendar days, archive paths and tariffs are all reckoned in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of this session."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(
            "spark.checkpoint.dir is unset: name a folder that all executors share"
        )
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="gridloom-")
    return _local_root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder below the shared root."""
    path = f"{shared_root(spark)}/gridloom/{purpose}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def owned_folders(spark: SparkSession) -> Iterator[list[str]]:
    """Remove at the end of the block every folder that was named inside it.

    Results read tables that were written on their way; build and store such a result
    inside the block, and nothing of it stays behind, even if the block fails.  What is
    used longer, as a registry snapshot, is made before it.  Blocks may be nested.
    Threads started inside, as those of a stream, keep their folders.
    """
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield paths
    finally:
        _owned.reset(token)
        for path in paths:
            remove(spark, path)


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a DataFrame to the shared folder and go on from the written table.

    For a result that several branches of a plan read: it is computed once, and
    an executor that is lost later costs a re-read instead of the whole lineage.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._settled_at = path
    return table


def discard(table: DataFrame) -> None:
    """Remove a settled table that nothing reads any more."""
    path = vars(table).pop("_settled_at", None)
    if path and not remove(table.sparkSession, path):
        raise OSError(f"could not remove {path}")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder; false if it is still there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(where, True) or not files.exists(where)
