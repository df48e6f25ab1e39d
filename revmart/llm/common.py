"""Helpers shared by the operators: tables, words, folds, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

# Small Arrow batches keep a Python worker's memory bounded where documents are long.
LLM_CONFS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
}


def apply_llm_confs(spark: SparkSession) -> None:
    for key, value in LLM_CONFS.items():
        spark.conf.set(key, value)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per SparkContext.

    Functions that run there refer to them; a session may have been started
    without the repository on its workers' path.
    """
    sc = spark.sparkContext
    if getattr(sc, "_revmart_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="revmart-")) / "revmart_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._revmart_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as fold 0)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % modulus, F.lit(0))


def ascii_lower(col: str | Column) -> Column:
    """Null text counts as empty; only A-Z change."""
    col = F.col(col) if isinstance(col, str) else col
    return F.translate(F.coalesce(col, F.lit("")), UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words split at space and U+0009..U+000D, as UTF-8.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is exactly
    that rule.
    """
    return text.encode("utf-8", "replace").lower().split() if text else []


def neutral_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns named c0, c1, ..., which meet no name used inside an operator; and old name -> new."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder in the cluster-shared dir and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """About the n rows of smallest seeded id hash, n at most.

    A threshold on the hash first leaves some 2n rows of the whole table, so
    the limit never gathers n rows from every task.
    """
    total = df.count()
    h = F.xxhash64(F.lit(seed), F.col(id_col))
    span = 2**64 * min(1.0, 2 * n / max(1, total)) - 2**63
    few = df if total <= 2 * n else df.filter(h < F.lit(int(span)))
    return few.orderBy(h, id_col).limit(n)


def limited(batches: Iterable[pa.RecordBatch], text: str, max_chars: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_chars`` of text, one row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_pylist()
        first = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > max_chars:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        yield batch.slice(first)
