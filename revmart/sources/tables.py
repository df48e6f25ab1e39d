"""Parquet table scans and layer naming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (pruning and pushdown happen at the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def layer_table(root: str, layer: str, name: str) -> str:
    """Path of a table in a warehouse layer (raw, staging, snapshots, intermediate, marts)."""
    return f"{root.rstrip('/')}/{layer}/{name}"
