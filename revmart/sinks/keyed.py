"""A table with one row per key, kept as a base and the changes since.

    <root>/base/v=<version>.b=<buckets>/      every row as of the version
    <root>/changes/v=<version>.b=<buckets>/   the rows that are new or changed in the version

Both are plain Parquet written by Spark, bucketed by the key and sorted
within the buckets, so that a merge reads the base where it lies and moves
the changes only. A run adds its changed rows and rewrites nothing; after
some runs, or when the changes have grown against the base, ``fold`` writes
the next base. The number of buckets follows the number of rows, so that a
task, which has a bucket, reads and sorts no more in a larger table; changes
that are many more than the base have buckets of their own number. A folder
counts once Spark's job commit has put ``_SUCCESS`` there; re-running a
version replaces its own folder only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from revmart.sinks.storage import _fs

_FOLDER = re.compile(r"^v=(.+)\.b=(\d+)$")


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str],
                 rows_per_bucket: int = 500_000) -> None:
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self.rows_per_bucket = rows_per_bucket

    # ---- folders ---------------------------------------------------------

    def _folders(self, kind: str) -> dict[str, int]:
        """Committed versions of ``kind`` -> their number of buckets."""
        fs, path, jvm = _fs(self.spark, f"{self.root}/{kind}")
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, "v=*/_SUCCESS")) or []
        names = (_FOLDER.match(s.getPath().getParent().getName()) for s in found)
        return {m.group(1): int(m.group(2)) for m in names if m}

    def _path(self, kind: str, version: str, buckets: int) -> str:
        return f"{self.root}/{kind}/v={version}.b={buckets}"

    def _table(self, path: str) -> str:
        return "revmart_" + hashlib.md5(path.encode()).hexdigest()

    def _read(self, kind: str, version: str, buckets: int) -> DataFrame:
        path = self._path(kind, version, buckets)
        name, keys = self._table(path), ", ".join(f"`{k}`" for k in self.keys)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                       f"SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def _write(self, rows: DataFrame, kind: str, version: str, buckets: int) -> None:
        path = self._path(kind, version, buckets)
        (rows.select(*self.schema.fieldNames()).repartition(buckets, *self.keys)
         .write.format("parquet").mode("overwrite").bucketBy(buckets, *self.keys).sortBy(*self.keys)
         .option("path", path).saveAsTable(self._table(path)))

    def _delete(self, kind: str, version: str, buckets: int) -> None:
        path = self._path(kind, version, buckets)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(path)}")
        fs, hpath, _ = _fs(self.spark, path)
        fs.delete(hpath, True)

    # ---- reading ---------------------------------------------------------

    def versions(self) -> set[str]:
        """Versions whose state can be read."""
        return set(self._folders("base")) | set(self._folders("changes"))

    def _parts(self, upto: str | None) -> tuple[tuple[str, int] | None, list[tuple[str, int]]]:
        """The base that holds as of ``upto``, and the changes after it, oldest first."""
        bases = {v: b for v, b in self._folders("base").items() if upto is None or v <= upto}
        if not bases:
            return None, []
        base = max(bases)
        changes = sorted((v, b) for v, b in self._folders("changes").items()
                         if v > base and (upto is None or v <= upto))
        return (base, bases[base]), changes

    def read(self, upto: str | None = None, columns: list[str] | None = None) -> DataFrame:
        """The rows as of version ``upto`` (by default the newest); ``columns`` must hold the keys."""
        columns = columns or self.schema.fieldNames()
        base, changes = self._parts(upto)
        if base is None:
            return self.spark.createDataFrame([], self.schema).select(*columns)
        layers = [self._read("base", *base).select(*columns),
                  *(self._read("changes", *c).select(*columns) for c in changes)]
        return reduce(DataFrame.unionByName, [
            layer.join(reduce(DataFrame.unionByName, [x.select(*self.keys) for x in layers[i + 1:]]),
                       on=self.keys, how="left_anti").select(*columns) if layers[i + 1:] else layer
            for i, layer in enumerate(layers)])

    def changes(self, version: str) -> DataFrame:
        """The rows that ``version`` wrote: its changes, or its base where it was the first."""
        kind = "changes" if version in self._folders("changes") else "base"
        return self._read(kind, version, self._folders(kind)[version])

    # ---- writing ---------------------------------------------------------

    def _buckets(self, rows: int, now: int = 1) -> int:
        """Buckets of so many rows: those there are now, unless they would hold twice what they should."""
        wanted = min(-(-rows // self.rows_per_bucket), int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
        return wanted if wanted > 2 * now else now

    def placed(self, rows: DataFrame, after: str | None, at_most: int) -> DataFrame:
        """``rows`` dealt by the key as ``create`` (``after`` None) or ``put`` will: what is then done by key,
        a join with the rows as of ``after`` too, and the write need no further exchange."""
        return rows.repartition(self._put_buckets(after, at_most) if after else self._buckets(at_most), *self.keys)

    def _put_buckets(self, after: str, at_most: int | None) -> int:
        base, _ = self._parts(after)
        if base is None:
            raise ValueError(f"{self.root} has no base up to {after}")
        return self._buckets(at_most or 0, base[1])

    def create(self, rows: DataFrame, version: str, at_most: int) -> None:
        """A first base (or a new one, whatever was there) of at most ``at_most`` rows."""
        for kind in ("base", "changes"):  # of an earlier attempt at this version
            if version in self._folders(kind):
                self._delete(kind, version, self._folders(kind)[version])
        self._write(rows, "base", version, self._buckets(at_most))

    def put(self, rows: DataFrame, version: str, after: str, at_most: int | None = None) -> None:
        """Rows, one a key and ``at_most`` so many, that replace or join those as of version ``after``."""
        if version in self._folders("base"):  # folded by an earlier attempt
            self._delete("base", version, self._folders("base")[version])
        self._write(rows, "changes", version, self._put_buckets(after, at_most))

    def fold(self, version: str, most_changes: int = 8, share: float = 0.25) -> bool:
        """Write the state as of ``version`` as the next base, if the changes are many or large."""
        base, changes = self._parts(version)
        if base is None or not changes:
            return False
        fs, _, jvm = _fs(self.spark, self.root)
        size = lambda kind, at: fs.getContentSummary(
            jvm.org.apache.hadoop.fs.Path(self._path(kind, *at))).getLength()
        if len(changes) < most_changes and sum(size("changes", c) for c in changes) < share * size("base", base):
            return False
        rows = self.read(version)
        # counting the layers reads Parquet footers only; replaced rows count twice
        most = sum(self._read(k, *at).count() for k, at in [("base", base), *(("changes", c) for c in changes)])
        with self._by_bucket():
            self._write(rows, "base", version, self._buckets(most, max(base[1], *(b for _, b in changes))))
        return True

    @contextmanager
    def _by_bucket(self) -> Iterator[None]:
        """Scans keep one task a bucket where no join asks for it: else Spark packs buckets into splits, and
        a task of a fold sorts a split of rows, and each writes a file into every bucket."""
        name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, "false")
        try:
            yield
        finally:
            self.spark.conf.set(name, before)

    def discard(self, after: str | None, before: str) -> None:
        """Delete what lies between two versions: a caller knows that those runs were never finished.

        Without it the rows of a half-done run would show through where a later run, which starts from
        ``after``, does not write their keys.
        """
        for kind in ("base", "changes"):
            for v, b in self._folders(kind).items():
                if (after is None or v > after) and v < before:
                    self._delete(kind, v, b)

    def prune(self, keep: str) -> int:
        """Delete the folders that no reader as of ``keep`` or later needs; returns how many."""
        base, _ = self._parts(keep)
        gone = [(kind, v, b) for kind in ("base", "changes") for v, b in self._folders(kind).items()
                if base and (v < base[0] or kind == "changes" and v == base[0])]
        for item in gone:
            self._delete(*item)
        return len(gone)
