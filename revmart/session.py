"""Session helpers: the confs the jobs rely on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Confs every job assumes. Session zone UTC keeps timestamp_ntz arithmetic
# free of zone shifts; ANSI makes decimal overflow raise instead of NULL.
JOB_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # streaming state (one winner per payment) lives in RocksDB, not the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "revmart", driver_memory: str | None = None) -> SparkSession:
    """Session for tests and the local benchmark (the cluster brings its own)."""
    driver_memory = driver_memory or os.environ.get("REVMART_DRIVER_MEMORY") or _default_heap()
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in JOB_CONFS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_confs(spark)
    return spark


def _default_heap() -> str:
    """8 GB, or 60% of physical memory on a smaller machine (local mode: driver = executors)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(8, int(total * 0.6 / 2**30)))}g"


def apply_job_confs(spark: SparkSession) -> None:
    for key, value in JOB_CONFS.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only in local mode (tests, ad-hoc runs) a missing
    setting is made up for by a local folder: on a cluster the driver and the
    executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="revmart-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared dir for one job run's tables."""
    return f"{shared_dir(spark)}/revmart/{name}-{uuid.uuid4().hex[:12]}"
