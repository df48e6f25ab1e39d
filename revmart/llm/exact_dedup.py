"""Exact de-duplication against a persistent digest index.

The index is a table of (digest, keep_id), bucketed and sorted by digest and
appended to by every batch. A new batch is reduced to one candidate per
digest (partial aggregation, so a text with a third of all rows costs one
row per task), anti-joined with the index by sort-merge (the index side
reads its buckets without a shuffle) and the survivors are appended.

Re-running a batch is harmless: its digests are in the index already, so
nothing is appended, and the decisions come out the same.

Defined results: a null text equals an empty one; of equal texts the row
with the largest id stays (a null id only if there is no other); of rows
that share id and text one stays; an empty table gives no rows; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.llm.common import ascii_lower, materialise, neutral_names, shuffle_partitions


class DigestIndex:
    """The digest table at ``path``; registered in the session's catalog as ``name``.

    Its buckets are as many as the session's shuffle partitions when it is
    made, unless ``buckets`` says otherwise.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, buckets: int | None = None) -> None:
        buckets = buckets or shuffle_partitions(spark)
        self.spark, self.path, self.name, self.buckets = spark, path, name, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, candidates: DataFrame) -> None:
        """Append the (digest, keep_id) rows whose digest the index lacks."""
        fresh = candidates.select("digest", "keep_id").join(
            self.read().select("digest").hint("merge"), "digest", "left_anti")
        (fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .select("digest", F.col("keep_id").cast("bigint")).write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)


def _falling(rows: DataFrame, batches: int) -> list[DataFrame]:
    """``rows`` by ranges of doc_id, the largest ids first and null ids last; any bounds give the same decisions."""
    shares = [i / batches for i in range(1, batches)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else None
    out, above = [], F.lit(True)
    for cut in sorted(set(cuts or []), reverse=True):
        at_least = F.coalesce(F.col("doc_id") >= cut, F.lit(False))
        out.append(rows.filter(above & at_least))
        above = ~at_least
    return [*out, rows.filter(above)]


def _decide(docs: DataFrame, index: DigestIndex, id_col: str, text_col: str, batches: int) -> DataFrame:
    """(digest, doc_id, n, keep_id, group_size): a row per id and text, n its number of rows."""
    digests = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), digest_of(text_col).alias("digest"))
    rows = materialise(digests.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n")), "digests")
    # The first batch that holds a text holds its largest id: later ones meet it in the index.
    for batch in _falling(rows, batches):
        index.add(materialise(batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), "candidates"))
    groups = rows.groupBy("digest").agg(F.sum("n").alias("group_size"))
    # Read by path below, not as a bucketed table: both sides are then exchanged,
    # and the adaptive plan can split the partition of a text with very many copies.
    resolved = materialise(groups.join(index.read().hint("merge"), "digest"), "resolved")
    return rows.join(resolved, "digest")


def digest_of(text_col: str) -> Column:
    return F.unhex(F.sha2(ascii_lower(text_col), 256))


def dedup_batch(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id",
                text_col: str = "text", batches: int = 1) -> DataFrame:
    """Decide every row of ``docs`` and append its new texts to the index, in ``batches`` falling id ranges.

    Returns one row per input row: the id, keep_id (the row that stays, of
    ``docs`` or of an earlier call), group_size (equal texts in ``docs``),
    kept and text_sha256.
    """
    return (_decide(docs, index, id_col, text_col, batches)
            .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
            .select("doc_id", "keep_id", F.col("group_size").cast("bigint").alias("group_size"),
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def keep_first(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """The rows of ``docs`` (with doc_id and text) that stay, their columns as they were."""
    kept = materialise(
        _decide(docs, index, "doc_id", "text", batches).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "n"), "kept")

    rows, names = neutral_names(docs)
    own = list(names.values())
    marked = rows.select(*own, digest_of(names["text"]).alias("digest_of"),
                         F.col(names["doc_id"]).cast("bigint").alias("row_id"))

    def rows_of(which: DataFrame) -> DataFrame:
        return marked.join(which, (F.col("digest_of") == F.col("_digest"))
                           & F.col("row_id").eqNullSafe(F.col("_id")), "left_semi")

    once = rows_of(kept.filter("n = 1")).select(*own).toDF(*docs.columns)
    repeated = kept.filter("n > 1")
    if repeated.isEmpty():  # the usual case: no row repeats another's id and text
        return once
    return once.unionByName(rows_of(repeated).dropDuplicates(["digest_of"]).select(*own).toDF(*docs.columns))
