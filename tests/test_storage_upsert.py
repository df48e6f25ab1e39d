import os

from revmart.operators.dedup import SortKey
from revmart.operators.upsert import insert_if_absent, keyed_upsert
from revmart.session import scratch_path
from revmart.sinks.storage import committed_versions, prune_versions, read_current, write_version

SCHEMA = "id string, v int, d string"


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_keyed_upsert_cases(spark):
    existing = spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d1")], SCHEMA)
    overlap = spark.createDataFrame([("b", 20, "d2"), ("c", 30, "d2")], SCHEMA)
    assert _set(keyed_upsert(existing, overlap, ["id"])) == [("a", 1, "d1"), ("b", 20, "d2"),
                                                             ("c", 30, "d2")]
    empty = spark.createDataFrame([], SCHEMA)
    assert _set(keyed_upsert(existing, empty, ["id"])) == _set(existing)
    disjoint = spark.createDataFrame([("z", 9, "d3")], SCHEMA)
    assert len(_set(keyed_upsert(existing, disjoint, ["id"]))) == 3


def test_insert_if_absent_first_wins(spark):
    existing = spark.createDataFrame([("a", 1, "old")], SCHEMA)
    incoming = spark.createDataFrame([("a", 5, "x"), ("b", 3, "late"), ("b", 2, "early")], SCHEMA)
    out = insert_if_absent(existing, incoming, ["id"], [SortKey("v", descending=False)])
    assert _set(out) == [("a", 1, "old"), ("b", 2, "early")]


def test_versions_ignore_uncommitted_and_rerun_is_idempotent(spark):
    root = scratch_path(spark, "versions")
    df1 = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    write_version(df1, root, "0001")
    # a crashed run: folder without the _SUCCESS commit marker
    os.makedirs(f"{root}/v=0002".replace("file:", ""), exist_ok=True)
    assert committed_versions(spark, root) == ["0001"]
    assert _set(read_current(spark, root, df1.schema)) == [("a", 1, "x")]
    df2 = spark.createDataFrame([("a", 2, "y")], SCHEMA)
    write_version(df2, root, "0002")
    write_version(df2, root, "0002")  # the same run again
    assert _set(read_current(spark, root, df1.schema)) == [("a", 2, "y")]


def test_read_current_of_missing_table_is_empty(spark):
    root = scratch_path(spark, "missing")
    assert read_current(spark, root, "id string").count() == 0


def test_prune_versions_keeps_newest(spark):
    root = scratch_path(spark, "prune")
    for i in range(1, 5):
        write_version(spark.createDataFrame([("a", i, "x")], SCHEMA), root, f"000{i}")
    assert prune_versions(spark, root, keep=2) == ["0001", "0002"]
    assert committed_versions(spark, root) == ["0003", "0004"]
    assert [r.v for r in read_current(spark, root, SCHEMA).collect()] == [4]


def test_prune_partition_revisions(spark):
    import datetime as dt
    from pyspark.sql.types import StructType
    from revmart.sinks.partitioned import (overwrite_partitioned, prune_revisions,
                                           read_partitioned, upsert_partitioned)
    schema = StructType.fromDDL("id string, d date, x int")
    root = scratch_path(spark, "prune-part")
    overwrite_partitioned(spark, spark.createDataFrame(
        [("a", dt.date(2025, 1, 1), 1), ("b", dt.date(2025, 1, 2), 1)], schema), root, "d", "0001")
    upsert_partitioned(spark, root, schema, spark.createDataFrame(
        [("a", dt.date(2025, 1, 1), 2)], schema), ["id"], "d", "0002")
    before = sorted(map(tuple, read_partitioned(spark, root, schema, "d").collect()))
    assert prune_revisions(spark, root, "d") == 1  # only d=2025-01-01/0001 is superseded
    assert sorted(map(tuple, read_partitioned(spark, root, schema, "d").collect())) == before
