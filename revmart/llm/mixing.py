"""Mix sources to target weights by Sainte-Lague apportionment, in DataFrame operations only.

The mix is ``total words / block_words`` blocks of equal size. They are
apportioned to sources by the highest quotients target / (2k + 1), then each
source's blocks to its shards by the highest quotients of their sizes. A
shard lays its documents end to end in a seeded order and cuts that stream
into blocks; a quota of q of its n blocks takes every block q div n times
and a run of q mod n further blocks, from a seeded start and around the end.
So all but two documents of a shard are taken whole, and what a document
gives follows from its place in the stream without a row per block.

A shard has about as many words as the square root of the total (at least
``least_shard``), so a source with a third of all rows is many shards, and
neither a shard nor a source's list of shards grows as fast as the input.

Defined results: a null or empty text has size 0 and gives nothing; a null
source is a source, the last one; a source without words has target 0;
rows that share an id are each mixed; an empty table gives no rows. Columns
other than the id, text and source are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.llm.common import WORD, materialise

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def apportion(rows: DataFrame, group: list[str], order: list[str], weight: str, seats: str) -> DataFrame:
    """Add ``quota``: the row's part of its group's ``seats``, by the highest quotients weight / (2k + 1).

    A row gets at least as many seats as rounding gives it for n / 2 seats
    fewer, and at most as many as for n / 2 more (n: rows of the group), so
    only the quotients between these two, about 2n of them, are ranked.
    """
    whole = Window.partitionBy(*group)
    rows = (rows.withColumn("_w", F.sum(F.col(weight).cast("double")).over(whole))
            .withColumn("_n", F.count(F.lit(1)).over(whole)))
    share = lambda m: F.when(F.col("_w") > 0, F.greatest(
        F.lit(0).cast("bigint"), F.floor(F.col(weight) / F.col("_w") * m + F.lit(0.5)))).otherwise(0).cast("bigint")
    rows = (rows.withColumn("_low", share(F.col(seats) - F.col("_n") / 2))
            .withColumn("_top", F.greatest(F.col("_low"), share(F.col(seats) + F.col("_n") / 2 + 1)))
            .withColumn("_left", F.col(seats) - F.sum("_low").over(whole)))
    ranked = (rows.withColumn("_k", F.explode_outer(F.when(
        F.col("_top") > F.col("_low"), F.sequence("_low", F.col("_top") - 1))))
        .withColumn("_q", F.col(weight) / (F.col("_k") * 2 + 1))
        .withColumn("_rank", F.row_number().over(whole.orderBy(F.col("_q").desc_nulls_last(), *order))))
    won = F.when(F.col("_q").isNotNull() & (F.col("_rank") <= F.col("_left")), 1).otherwise(0)
    keep = [c for c in rows.columns if not c.startswith("_")]
    return (ranked.groupBy(*keep, "_low").agg(F.sum(won).alias("_won"))
            .select(*keep, (F.col("_low") + F.col("_won")).cast("bigint").alias("quota")))


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """From (source, size): source, rank, source_size, target.

    Sources by code point, null last, weigh ``weights``, repeating. The total
    is shared by weight; a target stops at ``most`` times its source's size
    and the excess is shared again. In the order of ceiling over weight the
    sources that stop are a prefix, so one pass of running sums finds them.
    """
    ranked = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
              .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = (ranked.withColumn("weight", weight.cast("bigint"))
              .withColumn("ceiling", F.col("source_size") * most))
    by = Window.orderBy(F.col("ceiling") / F.col("weight"), "rank")
    whole = Window.partitionBy()
    ranked = (ranked.withColumn("total", F.sum("source_size").over(whole))
              .withColumn("before", F.coalesce(F.sum("ceiling").over(
                  by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")))
              .withColumn("behind", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("stops", F.col("ceiling") / F.col("weight")
                          <= (F.col("total") - F.col("before")) / F.col("behind"))
              .withColumn("stopped", F.coalesce(F.sum(F.when(F.col("stops"), F.col("ceiling"))).over(whole),
                                                F.lit(0).cast("bigint")))
              .withColumn("open", F.sum(F.when(~F.col("stops"), F.col("weight"))).over(whole)))
    target = F.when(F.col("stops"), F.col("ceiling").cast("double")).otherwise(
        F.col("weight") * ((F.col("total") - F.col("stopped")) / F.col("open")))
    return ranked.select("source", "rank", "source_size", "total", target.alias("target"))


def _draw(*parts: Column) -> Column:
    """A number from 0 to 2^32 - 1, from the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


def _seeded(rows: DataFrame, seed: int) -> DataFrame:
    """Add ``_order``, the seeded hash that shards and orders documents."""
    return rows.withColumn("_order", F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"))))


def _shard(n_shards: Column) -> Column:
    return F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint") % n_shards


def mix_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = 3, block_words: int = 16,
             least_shard: int = 20_000, seed: int = 17) -> DataFrame:
    """The shards of the mix, from (doc_id, source, size).

    Returns per shard: source, source_size, target, n_shards, shard, each
    (times every word is taken), first and last (the further run, in words;
    ``last`` may pass the end) and around (the stream's length in whole blocks).
    """
    targets = (source_targets(sized, weights, most)
               .withColumn("seats", F.round(F.col("total") / block_words).cast("bigint"))
               .withColumn("n_shards", F.greatest(F.lit(1).cast("bigint"), F.ceil(
                   F.col("source_size") / F.greatest(F.lit(float(least_shard)), F.sqrt("total"))))))
    sources = materialise(apportion(targets.withColumn("all", F.lit(0)), ["all"], ["rank"], "target", "seats"),
                          "mix-sources").withColumnRenamed("quota", "blocks")
    s = sources.withColumnRenamed("source", "_source")
    shards = (_seeded(sized, seed).join(s, F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("shard", _shard(F.col("n_shards")))
              .groupBy("_source", "rank", "source_size", "target", "n_shards", "blocks", "shard")
              .agg(F.sum("size").alias("words")).withColumnRenamed("_source", "source"))
    quotas = apportion(shards, ["rank"], ["shard"], "words", "blocks")
    n = F.ceil(F.col("words") / block_words)
    each = F.when(n > 0, F.least(F.floor(F.col("quota") / n), F.lit(most).cast("bigint"))).otherwise(0)
    further = F.when(F.col("each") < most, F.col("quota") - F.col("each") * F.col("n")).otherwise(0)
    first = F.when(F.col("n") > 0, _draw(F.lit(str(seed)), F.col("rank"), F.col("shard")) % F.col("n")).otherwise(0)
    plan = (quotas.withColumn("n", n).withColumn("each", each)
            .withColumn("first", first * block_words)
            .withColumn("last", F.col("first") + further * block_words)
            .withColumn("around", F.col("n") * block_words))
    return materialise(plan.select("source", "source_size", "target", "n_shards", "shard", *(
        F.col(c).cast("bigint").alias(c) for c in ("each", "first", "last", "around"))), "mix-shards")


def mix_rows(rows: DataFrame, plan: DataFrame, seed: int = 17) -> DataFrame:
    """Apply a plan to (doc_id, source, size, ...): adds source_size, target, each, taken and the
    document's words of the further run, from_1..to_1 and (around the end) from_2..to_2."""
    per_source = plan.select(F.col("source").alias("_source"), F.col("n_shards").alias("_n")).distinct()
    placed = (_seeded(rows, seed).join(per_source, F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("_shard", _shard(F.col("_n"))).drop("_source", "_n"))
    stream = Window.partitionBy("source", "_shard").orderBy("_order", "doc_id", "size")
    placed = placed.withColumn("_at", F.coalesce(F.sum("size").over(
        stream.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")))
    p = plan.select(F.col("source").alias("_source"), F.col("shard").alias("_of"), "source_size", "target",
                    "each", F.col("first").alias("_first"), F.col("last").alias("_last"),
                    F.col("around").alias("_around"))
    joined = placed.join(p, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_of")))
    zero = F.lit(0).cast("bigint")
    inside = lambda x: F.greatest(zero, F.least(F.col("size"), x - F.col("_at")))
    joined = (joined.withColumn("from_1", inside(F.col("_first"))).withColumn("to_1", inside(F.col("_last")))
              .withColumn("from_2", zero).withColumn("to_2", inside(F.col("_last") - F.col("_around"))))
    taken = F.col("each") * F.col("size") + (F.col("to_1") - F.col("from_1")) + F.col("to_2")
    return joined.withColumn("taken", taken).drop(
        "_source", "_of", "_first", "_last", "_around", "_at", "_order", "_shard")


def mix_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    sized = materialise(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source",
                                    word_count(F.col("text")).alias("size")), "mix-sizes")
    return mix_rows(sized, mix_plan(sized)).select("doc_id", "size", "source_size", "target", "taken")


def mixed_texts(docs: DataFrame) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row per whole taking of a document and one for a
    taking in part (its words, joined by single spaces; ``n_chars`` follows where that column exists)."""
    sized = materialise(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source",
                                    word_count(F.col("text")).alias("size")), "mix-sizes")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source",
                       word_count(F.col("text")).alias("size"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    mixed = mix_rows(rows, mix_plan(sized))
    part = F.col("to_1") - F.col("from_1") + F.col("to_2")
    words = F.regexp_extract_all(F.col("row")["text"], F.lit(WORD), F.lit(0))
    cut = F.array_join(F.concat(
        F.slice(words, F.lit(1), F.col("to_2").cast("int")),
        F.slice(words, (F.col("from_1") + 1).cast("int"), (F.col("to_1") - F.col("from_1")).cast("int"))), " ")
    takings = F.concat(
        F.array_repeat(F.col("row")["text"], F.col("each").cast("int")),
        F.when((part > 0) & (part >= F.col("size")), F.array(F.col("row")["text"]))
        .when(part > 0, F.array(cut)).otherwise(F.array().cast("array<string>")))
    out = mixed.filter("taken > 0").select("row", F.explode(takings).alias("taking"))
    fields = {"text": F.col("taking"), "n_chars": F.char_length("taking").cast("bigint")}
    return out.select(*(fields.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


#: DuckDB SQL of ``mix_documents`` over a table or query ``{docs}``.
MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(
      coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS VARCHAR)) AS h
  FROM {docs}
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][CAST((rank - 1) % 3 + 1 AS INT)] AS weight, source_size * 3 AS ceiling,
    CAST(sum(source_size) OVER () AS BIGINT) AS total FROM per_source
), filled AS (
  SELECT *, ceiling / weight <= (total - coalesce(CAST(sum(ceiling) OVER (
      ORDER BY ceiling / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
    / CAST(sum(weight) OVER (ORDER BY ceiling / weight, rank
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS stops FROM weighed
), targets AS (
  SELECT source, rank, source_size, CAST(round(total / 16) AS BIGINT) AS seats,
    greatest(1, CAST(ceil(source_size / greatest(20000.0::DOUBLE, sqrt(total))) AS BIGINT)) AS n_shards,
    CASE WHEN stops THEN CAST(ceiling AS DOUBLE) ELSE weight * ((total - coalesce(CAST(
      sum(CASE WHEN stops THEN ceiling END) OVER () AS BIGINT), 0))
      / CAST(sum(CASE WHEN NOT stops THEN weight END) OVER () AS BIGINT)) END AS target
  FROM filled
), seats1 AS (
  SELECT rank, count(*) FILTER (place <= seats) AS blocks FROM (
    SELECT rank, seats, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank) AS place
    FROM (SELECT rank, seats, target, unnest(range(0, CAST(ceil(target / 16) AS BIGINT) + 2)) AS k
          FROM targets WHERE target > 0)) GROUP BY rank
), shards AS (
  SELECT t.rank, t.source, ANY_VALUE(t.source_size) AS source_size, ANY_VALUE(t.target) AS target,
    ANY_VALUE(n_shards) AS n_shards, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % n_shards AS shard,
    CAST(sum(size) AS BIGINT) AS words, ANY_VALUE(coalesce(blocks, 0)) AS blocks
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN seats1 q ON q.rank = t.rank
  GROUP BY t.rank, t.source, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % n_shards
), seats2 AS (
  SELECT rank, shard, count(*) FILTER (place <= blocks) AS quota FROM (
    SELECT rank, shard, blocks, row_number() OVER (
      PARTITION BY rank ORDER BY words / (2 * k + 1) DESC, shard) AS place
    FROM (SELECT rank, shard, blocks, words,
            unnest(range(0, CAST(ceil(1.0 * blocks * words / sum_words) AS BIGINT) + 2)) AS k
          FROM (SELECT *, sum(words) OVER (PARTITION BY rank) AS sum_words FROM shards) WHERE words > 0))
  GROUP BY rank, shard
), plan AS (
  SELECT *, CASE WHEN n > 0 THEN CAST(('0x' || substr(md5('17:' || rank || ':' || shard), 1, 8)) AS BIGINT) % n
      ELSE 0 END * 16 AS first_word,
    CASE WHEN n > 0 THEN least(quota // n, 3) ELSE 0 END AS each
  FROM (SELECT s.*, coalesce(quota, 0) AS quota, CAST(ceil(words / 16) AS BIGINT) AS n
        FROM shards s LEFT JOIN seats2 USING (rank, shard))
), stream AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.each, p.first_word,
    p.first_word + CASE WHEN each < 3 THEN quota - each * n ELSE 0 END * 16 AS last_word, n * 16 AS around,
    coalesce(CAST(sum(d.size) OVER (PARTITION BY p.rank, p.shard ORDER BY h, d.doc_id NULLS FIRST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS pos
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
    AND CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % p.n_shards = p.shard
)
SELECT doc_id, size, source_size, target, CAST(each * size
  + greatest(0, least(size, last_word - pos)) - greatest(0, least(size, first_word - pos))
  + greatest(0, least(size, last_word - around - pos)) AS BIGINT) AS taken
FROM stream"""
