"""Partition-level copy-on-write for large keyed tables (the fact).

A full rewrite per incremental run does not scale to a 100 TB fact, so the
table is split by a partition column and a run rewrites only the partitions
it touches, each as a new revision:

    <root>/<col>=<value>/__rev=<version>/part-*.parquet   one partition revision
    <root>/<col>=<value>/__rev=<version>/_EMPTY           the partition became empty
    <root>/_commits/<version>                             written last: version committed

Spark writes the revisions with dynamic partition overwrite: only the
``(value, version)`` folders of this run are replaced, atomically per
folder at job commit, so re-running a version is idempotent and older
revisions are never touched. A reader takes, per partition value, the
greatest *committed* revision, so a crash before the commit marker leaves
the table as it was. Partition values are few (days or months), so
listing them and passing the touched set through the driver stays bounded.
Old revisions can be removed by a retention job once no reader uses them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revmart.operators.upsert import keyed_upsert
from revmart.sinks.storage import _fs

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a NULL (or empty) partition value
COMMITS = "_commits"
EMPTY = "_EMPTY"
REV = "__rev"


def _glob(fs, jvm, pattern: str) -> list:
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(pattern))
    return list(found) if found is not None else []


def _commits(spark: SparkSession, root: str) -> set[str]:
    fs, path, _ = _fs(spark, f"{root}/{COMMITS}")
    if not fs.exists(path):
        return set()
    return {s.getPath().getName() for s in fs.listStatus(path)}


def is_committed(spark: SparkSession, root: str, version: str) -> bool:
    fs, path, _ = _fs(spark, f"{root}/{COMMITS}/{version}")
    return fs.exists(path)


def folder_value(spark: SparkSession, value) -> str:
    """A partition value as it stands in a folder name; all sets of partition values hold these."""
    if value is None or value == "":
        return NULL_FOLDER
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def partition_versions(spark: SparkSession, root: str, part_col: str) -> dict[str, str]:
    """partition value -> its greatest committed revision (emptied ones too)."""
    committed = _commits(spark, root)
    fs, hroot, jvm = _fs(spark, root)
    found: dict[str, str] = {}
    if committed and fs.exists(hroot):
        for st in _glob(fs, jvm, f"{root}/{part_col}=*/{REV}=*"):
            path = st.getPath()
            version, value = path.getName().split("=", 1)[1], path.getParent().getName().split("=", 1)[1]
            if version in committed:
                found[value] = max(version, found.get(value, version))
    return found


def current_partitions(spark: SparkSession, root: str, part_col: str,
                       before: str | None = None) -> dict[str, str | None]:
    """partition value -> committed revision folder (None when emptied); two glob listings.

    With ``before`` only revisions older than it count (a run writing
    revision V reads with ``before=V``, so a re-run never reads its own output).
    """
    committed = {v for v in _commits(spark, root) if before is None or v < before}
    fs, hroot, jvm = _fs(spark, root)
    if not committed or not fs.exists(hroot):
        return {}
    latest: dict[str, tuple[str, str]] = {}
    for st in _glob(fs, jvm, f"{root}/{part_col}=*/{REV}=*"):
        path = st.getPath()
        version = path.getName().split("=", 1)[1]
        if version not in committed:
            continue
        value = path.getParent().getName().split("=", 1)[1]
        if value not in latest or version > latest[value][0]:
            latest[value] = (version, path.toString())
    emptied = {st.getPath().getParent().toString()
               for st in _glob(fs, jvm, f"{root}/{part_col}=*/{REV}=*/{EMPTY}")}
    return {value: (None if path in emptied else path) for value, (_, path) in latest.items()}


def read_partitioned(spark: SparkSession, root: str, schema: StructType, part_col: str,
                     only: set[str] | None = None, before: str | None = None) -> DataFrame:
    """Current state of the table (optionally just some partition values)."""
    parts = current_partitions(spark, root, part_col, before)
    paths = [p for value, p in parts.items() if p is not None and (only is None or value in only)]
    if not paths:
        return spark.createDataFrame([], schema)
    data_schema = StructType([f for f in schema.fields if f.name != part_col])
    df = spark.read.schema(data_schema).option("basePath", root).parquet(*paths)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def write_partitions(spark: SparkSession, rows: DataFrame, root: str, part_col: str, version: str,
                     touched: set[str], files_per_partition: int = 1,
                     spread_by: list[str] | None = None) -> None:
    """Write ``rows`` as revision ``version`` of their partitions, tombstone the
    ``touched`` partitions that got no rows, then commit."""
    # REBALANCE clusters rows by partition value (few files per partition)
    # and lets AQE split a hot partition (one day holding a third of the
    # rows) over several tasks; ``files_per_partition`` forces a spread.
    out = rows.withColumn(REV, F.lit(version))
    if files_per_partition > 1 and spread_by:
        out = out.withColumn("__spread", F.pmod(F.xxhash64(*spread_by), F.lit(files_per_partition)))
        out = out.hint("rebalance", part_col, "__spread").drop("__spread")
    else:
        out = out.hint("rebalance", part_col)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col, REV).parquet(root))
    fs, _, jvm = _fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    written = {st.getPath().getParent().getName().split("=", 1)[1]
               for st in _glob(fs, jvm, f"{root}/{part_col}=*/{REV}={version}")}
    for value in touched - written:  # the partition lost all its rows
        marker_dir = Path(f"{root}/{part_col}={value}/{REV}={version}")
        fs.mkdirs(marker_dir)
        fs.create(Path(marker_dir, EMPTY), True).close()
    commit = Path(f"{root}/{COMMITS}/{version}")
    fs.mkdirs(commit.getParent())
    fs.create(commit, True).close()


def overwrite_partitioned(spark: SparkSession, df: DataFrame, root: str, part_col: str,
                          version: str, files_per_partition: int = 1,
                          spread_by: list[str] | None = None) -> None:
    """Full load: every partition of ``df`` (and tombstones for the rest) as ``version``."""
    existing = set(current_partitions(spark, root, part_col, before=version))
    write_partitions(spark, df, root, part_col, version, existing, files_per_partition,
                     spread_by)


def upsert_partitioned(spark: SparkSession, root: str, schema: StructType, delta: DataFrame,
                       keys: list[str], part_col: str, version: str,
                       files_per_partition: int = 1, homes: DataFrame | None = None) -> set[str]:
    """delete+insert by key, rewriting only the partitions the delta touches.

    Touched = partitions of the delta rows plus partitions where the delta's
    keys live now (a key whose partition value moved leaves its old one).
    A caller that knows where the keys can live passes ``homes``, a frame of
    ``part_col`` values that holds at least those; without it the key column
    of the whole table is searched. NULL is a partition value like any other.
    Returns the touched partition values (as folder names).
    """
    # used three times below; cached (recomputed from lineage if an executor is lost)
    delta = delta.select(*schema.fieldNames()).persist(StorageLevel.MEMORY_AND_DISK)
    if homes is None:
        current = read_partitioned(spark, root, schema, part_col, before=version)
        homes = current.select(*keys, part_col).join(delta.select(*keys), on=keys, how="left_semi")
    touched_rows = delta.select(part_col).distinct().unionByName(
        homes.select(part_col).distinct()).distinct().collect()
    touched = {folder_value(spark, r[0]) for r in touched_rows}
    if touched:
        old = read_partitioned(spark, root, schema, part_col, only=touched, before=version)
        write_partitions(spark, keyed_upsert(old, delta, keys), root, part_col, version,
                         touched, files_per_partition, keys)
    delta.unpersist()
    return touched


def prune_revisions(spark: SparkSession, root: str, part_col: str) -> int:
    """Delete partition revisions no reader will pick any more.

    Per partition value, everything older than its current committed
    revision goes, committed or not; revisions newer than the latest commit
    are left alone (a run may be writing them). Returns folders deleted.
    """
    committed = _commits(spark, root)
    if not committed:
        return 0
    newest = max(committed)
    fs, _, jvm = _fs(spark, root)
    latest_version: dict[str, str] = {}
    revisions = _glob(fs, jvm, f"{root}/{part_col}=*/{REV}=*")
    for st in revisions:
        path = st.getPath()
        version = path.getName().split("=", 1)[1]
        value = path.getParent().getName().split("=", 1)[1]
        if version in committed and version > latest_version.get(value, ""):
            latest_version[value] = version
    deleted = 0
    for st in revisions:
        path = st.getPath()
        version = path.getName().split("=", 1)[1]
        value = path.getParent().getName().split("=", 1)[1]
        if version < latest_version.get(value, "") and version <= newest:
            fs.delete(path, True)
            deleted += 1
    # commit markers that no revision needs any more
    needed = set(latest_version.values()) | {newest}
    for version in committed - needed:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{COMMITS}/{version}"), True)
    return deleted
