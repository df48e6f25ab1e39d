"""Versioned and batch-appended parquet tables."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_VERSION_DIR = re.compile(r"^v=(.+)$")


def version_id(run_ts: str | dt.datetime) -> str:
    """Sortable folder id of a run, from its timestamp."""
    if isinstance(run_ts, str):
        run_ts = dt.datetime.fromisoformat(run_ts)
    return run_ts.strftime("%Y%m%dT%H%M%S%f")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath, jvm


def committed_versions(spark: SparkSession, root: str) -> list[str]:
    """Versions under ``root`` whose Spark job committed (``_SUCCESS`` present)."""
    fs, hroot, jvm = _fs(spark, root)
    if not fs.exists(hroot):
        return []
    out = []
    for status in fs.listStatus(hroot):
        name = status.getPath().getName()
        m = _VERSION_DIR.match(name)
        if m and status.isDirectory() and fs.exists(
                jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            out.append(m.group(1))
    return sorted(out)


def current_version(spark: SparkSession, root: str, before: str | None = None) -> str | None:
    """Greatest committed version (only those older than ``before`` when given).

    A run that writes version V reads with ``before=V``: re-running V after
    a crash then sees exactly what the first attempt saw, never its own output.
    """
    versions = [v for v in committed_versions(spark, root) if before is None or v < before]
    return versions[-1] if versions else None


def read_current(spark: SparkSession, root: str, schema: StructType,
                 before: str | None = None) -> DataFrame:
    """The latest committed version (older than ``before``), or an empty table of ``schema``."""
    version = current_version(spark, root, before)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/v={version}")


def write_version(df: DataFrame, root: str, version: str,
                  partition_by: list[str] | None = None) -> str:
    """Write ``df`` as version ``version`` of the table (idempotent per version)."""
    path = f"{root.rstrip('/')}/v={version}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def append_batch(df: DataFrame, root: str, batch_id: str) -> str:
    """Append-only sink: one folder per batch; a re-run of a batch replaces only it."""
    path = f"{root.rstrip('/')}/batch={batch_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_batch(spark: SparkSession, root: str, batch_id: str, schema: StructType) -> DataFrame:
    """One batch of an append-only table."""
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/batch={batch_id}")


def committed_batches(spark: SparkSession, root: str) -> list[str]:
    """Batch ids under ``root`` whose Spark job committed (``_SUCCESS`` present)."""
    fs, hroot, jvm = _fs(spark, root)
    if not fs.exists(hroot):
        return []
    marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/batch=*/_SUCCESS"))
    return sorted(m.getPath().getParent().getName().split("=", 1)[1] for m in marks or [])


def is_batch_committed(spark: SparkSession, root: str, batch_id: str) -> bool:
    """Whether one batch is committed; no listing."""
    fs, path, _ = _fs(spark, f"{root.rstrip('/')}/batch={batch_id}/_SUCCESS")
    return fs.exists(path)


def read_batches(spark: SparkSession, root: str, schema: StructType,
                 exclude: str | None = None, upto: str | None = None,
                 after: str | None = None) -> DataFrame:
    """All committed batches of an append-only table (uncommitted ones are hidden).

    ``exclude`` leaves out one batch (a re-run must not see its own earlier attempt);
    ``upto`` the batches after that one (a re-run must not see later runs' rows);
    ``after`` that one and those before it.
    """
    batches = [b for b in committed_batches(spark, root)
               if b != exclude and (upto is None or b <= upto) and (after is None or b > after)]
    if not batches:
        return spark.createDataFrame([], schema)
    paths = [f"{root.rstrip('/')}/batch={b}" for b in batches]
    return spark.read.schema(schema).parquet(*paths).select(*schema.fieldNames())


def read_version(spark: SparkSession, root: str, version: str, schema: StructType) -> DataFrame:
    """One committed version of a table."""
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/v={version}")


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` committed versions, and uncommitted
    folders older than the newest commit (leftovers of crashed runs).

    Run it when no reader still uses an old version; returns deleted versions.
    """
    fs, hroot, jvm = _fs(spark, root)
    if not fs.exists(hroot):
        return []
    committed = committed_versions(spark, root)
    if not committed:
        return []
    keep_set = set(committed[-keep:])
    newest = committed[-1]
    deleted = []
    for status in fs.listStatus(hroot):
        m = _VERSION_DIR.match(status.getPath().getName())
        if not (m and status.isDirectory()):
            continue
        version = m.group(1)
        if version in keep_set or version > newest:  # a newer run may be writing
            continue
        fs.delete(status.getPath(), True)
        deleted.append(version)
    return sorted(deleted)
