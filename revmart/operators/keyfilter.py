"""Bitmaps of hashed keys per partition: where may a key be?

For every partition value ``FILTERS`` bitmaps of its keys' hashes are kept,
in pieces of 32768 bits (Spark's ``bitmap_*`` functions). A key whose bit is
missing in any of them is not in the partition; where all are set it may be.
So the partitions that some of the given keys may be in hold all partitions
that they are in, and a join that reads only these is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = 3
BITS_PER_KEY = 16
PIECE_BITS = 32_768
FILTER_SCHEMA = "part string, filter int, piece long, pieces long, bits binary"
FILTER_KEYS = ["part", "filter", "piece"]


def pieces_for(keys: Column) -> Column:
    """Pieces of one bitmap of so many keys."""
    return F.greatest(F.lit(1), F.ceil(keys * BITS_PER_KEY / PIECE_BITS)).cast("long")


def _places(rows: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """One row per key and filter: the carried columns, filter, piece and bit (of ``pieces``)."""
    hashed = rows.select(*carried, F.explode(F.array(*[
        F.struct(F.lit(i).alias("filter"), F.xxhash64(F.lit(i), *keys).alias("h")) for i in range(FILTERS)])).alias("x"))
    return hashed.select(*carried, "x.filter", F.pmod("x.h", F.col("pieces")).alias("piece"),
                         F.pmod(F.shiftright("x.h", 32), F.lit(PIECE_BITS)).alias("bit"))


def build_filters(rows: DataFrame, keys: list[str], part_col: str) -> DataFrame:
    """The bitmaps of ``rows`` (with keys and ``part_col``, not NULL): ``FILTER_SCHEMA``.

    Bits are collected map-side, so what is shuffled is at most a bitmap per task.
    """
    sizes = rows.groupBy(F.col(part_col).alias("part")).agg(pieces_for(F.count(F.lit(1))).alias("pieces"))
    sized = rows.select(*keys, F.col(part_col).alias("of")).join(  # one row per partition
        F.broadcast(sizes), F.col("of") == F.col("part"))
    return _bitmaps(_places(sized, keys, ["part", "pieces"]))


def _bitmaps(places: DataFrame) -> DataFrame:
    return (places.groupBy("part", "filter", "piece").agg(
        F.max("pieces").alias("pieces"), F.bitmap_construct_agg("bit").alias("bits"))
        .select("part", "filter", "piece", "pieces", "bits"))


def add_keys(filters: DataFrame, rows: DataFrame, keys: list[str], part_col: str) -> DataFrame:
    """The pieces that change when ``rows`` join their partitions, and those of partitions that had none.

    A partition's bitmap keeps its number of pieces: rows that outgrow it raise the share of needless
    hits, and never hide a key.
    """
    known = F.broadcast(filters.select(F.col("part").alias("known"), "pieces").distinct())
    placed = rows.select(*keys, F.col(part_col).alias("part"))
    old = placed.join(known, F.col("part") == F.col("known")).drop("known")
    fresh = placed.join(known, F.col("part") == F.col("known"), "left_anti")
    came = _bitmaps(_places(old, keys, ["part", "pieces"]))
    touched = filters.join(came.select(*FILTER_KEYS), on=FILTER_KEYS, how="left_semi").select(*came.columns)
    merged = came.unionByName(touched).groupBy(*FILTER_KEYS).agg(
        F.max("pieces").alias("pieces"), F.bitmap_or_agg("bits").alias("bits"))
    return merged.unionByName(build_filters(fresh, keys, "part"))


def possible_parts(filters: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """(part): the partitions that may hold one of the keys of ``rows``.

    Each key is looked up in each partition: for batches that are small against the table.
    """
    parts = filters.select("part", "pieces").distinct().collect()  # one row per partition
    if not parts:
        return filters.select("part")
    each = F.array(*[F.struct(F.lit(r["part"]).alias("part"), F.lit(r["pieces"]).alias("pieces")) for r in parts])
    asked = rows.select(*keys).distinct().select(*keys, F.explode(each).alias("x")).select(*keys, "x.*")
    places = _places(asked, keys, [*keys, "part", "pieces"])
    byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1
    found = (places.join(filters.select(*FILTER_KEYS, "bits"), on=FILTER_KEYS, how="inner").where(hit)
             .groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") == FILTERS))
    return found.select("part").distinct()
