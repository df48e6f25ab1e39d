"""Connected components over an edge table: alternating large-star and small-star rounds.

Every round is two shuffled joins against per-node minima and is written to
the shared folder, so no lineage builds up. The minima are written before
they are joined: both join sides are then exchanges, and the adaptive plan
splits a node that holds a large part of all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that is not the smallest of its component."""
    e = materialise(edges.select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v"))
                    .filter("u <> v").distinct(), "edges")
    state = _state(e)
    while state[0]:
        # large star: every larger neighbour goes to the smallest node around
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least-large")
        large = materialise(e.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
                            .filter("u <> v").distinct(), "large-star")
        # small star: smaller neighbours and the node itself go to the smallest of them
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least-small")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).filter("u <> v"))
        e = materialise(small.distinct(), "small-star")
        if (after := _state(e)) == state:
            break
        state = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
