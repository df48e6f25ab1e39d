"""Relational sources read over JDBC.

The scan is split into ``num_partitions`` range queries on a numeric or
timestamp column so a large source is read by many tasks; filters given
with ``where`` are pushed into each query by Spark's JDBC source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def jdbc_scan(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              columns: list[str] | None = None, where: Column | str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 1000) -> DataFrame:
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(x is not None for x in split) and any(x is None for x in split):
        raise ValueError("a split scan needs partition_column, lower_bound, upper_bound and num_partitions")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetch_size))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    df = reader.load()
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*columns)
    return df
