"""Near-duplicate embeddings: random-hyperplane signs in several tables, exact
cosine verification, distributed connected components.

Equal vectors are one class first. A table's code is the signs of a cell's
planes and of further planes of its own; several tables share a cell's
planes. A class is dealt once to its cell of each cell table, with nothing
but its vector: what it moves follows the few cell tables, not all tables.
Inside a cell the classes of one code of one table are a bucket, and all its
cosines come from a blocked matrix product in double precision. What leaves
a cell is one row per linked class (its number of new links and the smallest
class it hangs together with), never the pairs. A pair that already shares a
bucket of an earlier table is not counted again: all codes are made again
from the vectors.

The bits per table follow the number of classes, so a bucket holds about
``bucket_rows`` of unrelated vectors; a cell's bits follow the bytes of all
vectors and codes, so a cell holds at most about ``cell_bytes`` of them; the
tables follow the bits, so that a pair exactly at the threshold is found with
probability ``recall`` (closer pairs more often). A cell over twice
``cell_bytes`` is split: its rows are dealt to blocks and every pair of blocks
is a group of its own. A group whose buckets hold over 256 times the pairs of
two blocks of ``block_rows`` is put off and split further the same way.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, and rows with a null id, link with nothing; vectors
of different length do not link; rows that share an id share a component;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import materialise, shuffle_partitions
from revmart.llm.components import components


def tables_and_bits(n: int, threshold: float, recall: float, bucket_rows: int) -> tuple[int, int]:
    """Bits per table and number of tables for n classes."""
    bits = min(60, max(1, math.ceil(math.log2(max(2, n) / bucket_rows)))) if n > bucket_rows else 1
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision (by the largest component first: no overflow)."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


class Layout(NamedTuple):
    """Tables of cells with ``cell_bits`` signs; in each, ``tables`` tables of buckets with ``bits`` further signs."""

    cell_bits: int
    cell_tables: int
    bits: int
    tables: int


def layout(n: int, size: int, threshold: float, recall: float, bucket_rows: int, cell_bytes: int) -> Layout:
    """Tables for n classes of ``size`` bytes together."""
    bits, tables = tables_and_bits(n, threshold, recall, bucket_rows)
    cell_bits = min(bits, math.ceil(math.log2(max(1.0, size / cell_bytes))))
    if not cell_bits:
        return Layout(0, 1, bits, tables)
    agree = 1 - math.acos(threshold) / math.pi
    tables, missed = 1, 1 - agree ** (bits - cell_bits)
    while missed**tables > 0.02:  # inside a cell both share; a little more than this costs a cell table
        tables += 1
    found = agree**cell_bits * (1 - missed**tables)
    return Layout(cell_bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - found))), bits - cell_bits, tables)


def _codes(vectors: np.ndarray, planes: np.ndarray, tables: int, rows: int = 1024) -> np.ndarray:
    """Codes by table and row; products of one shape, so a row has the same codes in whichever task they are made."""
    bits = planes.shape[1] // tables
    out = np.zeros((tables, len(vectors)), dtype=np.int64)
    for first in range(0, len(vectors) if bits else 0, rows):
        part = vectors[first:first + rows]
        block = np.zeros((rows, vectors.shape[1]))
        block[:len(part)] = part
        signs = (block @ planes >= 0).reshape(rows, tables, bits)[:len(part)]
        for b in range(bits):
            out[:, first:first + rows] |= signs[:, :, b].T.astype(np.int64) << b
    return out


def cell_codes(vectors: np.ndarray, at: Layout, seed: int) -> np.ndarray:
    """The cells of each vector, by cell table."""
    dim = vectors.shape[1]
    planes = np.random.default_rng([seed, dim, 1]).standard_normal((dim, at.cell_tables * at.cell_bits))
    return _codes(vectors, planes, at.cell_tables)


def bucket_codes(vectors: np.ndarray, cells: np.ndarray, at: Layout, seed: int, t: int) -> np.ndarray:
    """The buckets of each vector in the tables of cell table t, their cells' codes included."""
    dim, n = vectors.shape[1], at.tables * at.bits
    planes = np.random.default_rng([seed, dim]).standard_normal((dim, at.cell_tables * n))
    codes = _codes(vectors, np.ascontiguousarray(planes[:, t * n:(t + 1) * n]), at.tables) | cells[t] << at.bits
    return codes.astype(np.int32) if at.cell_bits + at.bits < 32 else codes


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """rep, copies and vectors of each batch, per vector length."""
    for batch in batches:
        rep, copies = (batch.column(c).to_numpy() for c in ("rep", "copies"))
        column = batch.column("vec")
        lengths = column.value_lengths().to_numpy()
        flat = column.flatten().to_numpy()
        starts = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            yield rep[at], copies[at], flat[starts[at][:, None] + np.arange(dim)]


def near_pairs(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float,
               chunk: int = 512, wide: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a row of ``left`` and one of ``right`` (the same array: each pair once) at the threshold or above."""
    for at in range(0, len(right), wide):
        columns = right[at:at + wide]
        others = vectors[columns].T
        for first in range(0, min(len(left), at + wide) if left is right else len(left), chunk):
            rows = left[first:first + chunk]
            i, j = np.divmod(np.flatnonzero(vectors[rows] @ others >= threshold), len(columns))
            i, j = rows[i], columns[j]
            yield (i[i < j], j[i < j]) if left is right else (i, j)


def _flat(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """The values of a column of bytes, one after the other."""
    raw = pa.concat_arrays([c.cast(pa.binary()) for c in column.chunks])
    ends = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1, raw.offset * 4)
    return np.frombuffer(raw.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind)


def link_cell(key: tuple, table: pa.Table, at: Layout, seed: int, threshold: float, width: str,
              most: float = math.inf) -> pa.Table:
    """One block of a cell against another (or itself): a row per class that links there.

    A group of over ``most`` pairs is put off: one row with the number of pairs.
    """
    dim, t, cell, bi, bj = (k.as_py() for k in key)
    order = np.argsort(table.column("rep").to_numpy(), kind="stable")  # the same on a retry
    rep, copies, block = (table.column(c).to_numpy()[order] for c in ("rep", "copies", "block"))
    n = len(rep)
    raw = _flat(table.column("vec"), width).reshape(n, dim)
    vectors = np.empty((n, dim))
    for first in range(0, n, 4096):
        vectors[first:first + 4096] = unit(raw[order[first:first + 4096]])
    del raw
    cells = cell_codes(vectors, at, seed)
    codes = bucket_codes(vectors, cells, at, seed, t)

    def buckets(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        by = np.argsort(code, kind="stable")
        for members in np.split(by, np.flatnonzero(np.diff(code[by])) + 1):
            left = members[block[members] == bi]
            yield left, left if bi == bj else members[block[members] == bj]

    pairs = sum(len(x) * (len(x) - 1) // 2 if x is y else len(x) * len(y) for code in codes for x, y in buckets(code))
    if pairs > most:
        return _linked(1, dim=[dim], t=[t], cell=[cell], bi=[bi], bj=[bj], pairs=[pairs])
    links, label = np.zeros(n, dtype=np.int64), np.arange(n)
    before: list[np.ndarray] = []  # codes of the tables before this one

    def settle(found: list[tuple[np.ndarray, np.ndarray]], s: int) -> None:
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        if not before and len(i):
            before.extend(code for earlier in range(t) for code in bucket_codes(vectors, cells, at, seed, earlier))
        for code in (*before, *codes[:s]):
            if not len(i):
                return
            new = code[i] != code[j]
            i, j = i[new], j[new]
        links[:] += np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
        unite(label, i, j)

    for s, code in enumerate(codes):
        found, held = [], 0
        for left, right in buckets(code):
            for i, j in near_pairs(vectors, left, right, threshold):
                found.append((i, j))
                held += len(i)
                if held > 1 << 20:
                    settle(found, s)
                    found, held = [], 0
        if held:
            settle(found, s)
    out = np.flatnonzero((links > 0) | (label != np.arange(n)))
    return _linked(len(out), rep=rep[out], links=links[out], root=rep[label[out]])


LINKED = pa.schema([(c, pa.int32() if c in ("dim", "t") else pa.int64())
                    for c in ("rep", "links", "root", "dim", "t", "cell", "bi", "bj", "pairs")])


def _linked(n: int, **columns: object) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in LINKED],
                    schema=LINKED)


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Lower ``label`` (each node's component, its smallest index) over the edges i-j."""
    while len(i) and (label[i] != label[j]).any():
        a, b = label[i], label[j]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label != label[label]).any():
            label[:] = label[label]


def _bytes(dim: Column) -> Column:
    """What a vector, its codes and its number take in the task of a cell."""
    return dim.cast("bigint") * 8 + 512


CELL = ["dim", "t", "cell"]
GROUP = [*CELL, "bi", "bj"]


def cell_rows(classes: DataFrame, at: Layout, width: str, seed: int) -> DataFrame:
    """A row per class and cell table: the cell, and the vector as bytes."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rep, copies, vecs in _by_length(batches):
            n, raw = len(rep), np.ascontiguousarray(vecs.astype(width))
            ends = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * (raw.nbytes // n))
            vec = pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(raw)])
            for t, cells in enumerate(cell_codes(unit(vecs), at, seed)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, vecs.shape[1], np.int32)), pa.array(np.full(n, t, np.int32)), pa.array(cells),
                     pa.array(rep), pa.array(copies), vec], [*CELL, "rep", "copies", "vec"])

    return classes.mapInArrow(rows, "dim int, t int, cell long, rep long, copies long, vec binary")


def cell_sizes(classes: DataFrame, at: Layout, seed: int) -> DataFrame:
    """Classes of each cell."""
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, vecs in _by_length(batches):
            for t, cells in enumerate(cell_codes(unit(vecs), at, seed)):
                cell, n = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "dim": np.full(len(n), vecs.shape[1], np.int32), "t": np.full(len(n), t, np.int32),
                    "cell": cell, "n": n})

    return classes.mapInArrow(sizes, "dim int, t int, cell long, n long").groupBy(CELL).agg(F.sum("n").alias("n"))


def linked(classes: DataFrame, at: Layout, size: int, threshold: float, width: str, seed: int, cell_bytes: int,
           most: int) -> DataFrame:
    """rep, links, root of the classes that link, a row per group of a cell."""
    rows = cell_rows(classes, at, width, seed)

    def dealt(rows: DataFrame) -> DataFrame:
        """A row to each pair of blocks that its own is in."""
        return (rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
                .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
                .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))

    def link(rows: DataFrame, most: float, name: str) -> DataFrame:
        parts = math.ceil(at.cell_tables * size / (64 << 20))  # else a task sorts more than its memory holds
        rows = rows.select(*GROUP, "rep", "copies", "block", "vec")
        rows = rows.repartition(parts, *GROUP) if parts > shuffle_partitions(classes.sparkSession) else rows
        return materialise(rows.groupBy(GROUP).applyInArrow(
            lambda key, table: link_cell(key, table, at, seed, threshold, width, most),
            ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'long'}" for f in LINKED)), name)

    bytes_ = F.col("n") * _bytes(F.col("dim"))
    split = materialise(cell_sizes(classes, at, seed).filter(bytes_ > 2 * cell_bytes)
                        .select(*CELL, F.ceil(bytes_ / cell_bytes).alias("blocks")), "split-cells")
    blocks = F.coalesce("blocks", F.lit(1).cast("bigint"))
    first = link(dealt(rows.join(F.broadcast(split), CELL, "left").withColumn("blocks", blocks)), most, "linked")
    off = first.filter("pairs is not null").select(*GROUP, "pairs")
    finer = materialise(
        off.join(F.broadcast(split), CELL, "left").groupBy(*CELL, blocks.alias("coarse"))
        .agg(F.ceil(F.sqrt(2 * F.max("pairs") / most)).alias("parts"))
        .select(*CELL, "coarse", (F.col("coarse") * F.col("parts")).alias("blocks")), "finer-cells")
    done = first.filter("pairs is null").select("rep", "links", "root")
    if finer.isEmpty():
        return done
    x, y = F.pmod("bi", "coarse"), F.pmod("bj", "coarse")  # the blocks that they were parts of
    again = (dealt(rows.join(F.broadcast(finer), CELL))
             .withColumn("low", F.least(x, y)).withColumn("high", F.greatest(x, y))
             .join(F.broadcast(off.select(*CELL, F.col("bi").alias("low"), F.col("bj").alias("high"))),
                   [*CELL, "low", "high"], "left_semi"))
    return done.unionByName(link(again, math.inf, "linked-again").select("rep", "links", "root"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                 recall: float = 0.995, bucket_rows: int = 512, block_rows: int = 2048, seed: int = 11,
                 cell_bytes: int = 96 << 20) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    element = vectors.schema[vec_col].dataType.elementType.simpleString()
    arrow, width = ("float", "<f4") if element == "float" else ("double", "<f8")
    vec = F.col(vec_col).cast(f"array<{arrow}>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col(id_col).isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), vec.alias("vec"), usable.alias("usable"))
    keyed = rows.filter("usable").withColumn("key", F.unhex(F.sha2(F.array_join(
        F.col("vec").cast("array<string>"), ","), 256)))
    classes = materialise(keyed.groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")), "vectors")
    n, size = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum(_bytes(F.size("vec"))), F.lit(0))).first()
    at = layout(n, size, threshold, recall, bucket_rows, cell_bytes)
    found = linked(classes.select("rep", "copies", "vec"), at, size, threshold, width, seed, cell_bytes,
                   256 * block_rows**2)
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comps = components(found.filter("rep <> root"), "rep", "root")
    resolved = materialise(
        classes.select("key", "rep", "copies").join(sums, "rep", "left")
        .join(comps, F.col("rep") == F.col("node"), "left")
        .select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "resolved")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    return (keyed.join(resolved, "key").select("vec_id", "n_links", "component_id").unionByName(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


#: DuckDB SQL of ``near_vectors`` over ``embeddings``, by all pairs.
NEAR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and([isfinite(coalesce(x, 'nan'::FLOAT)) FOR x IN embedding])
    AND list_bool_or([x <> 0 FOR x IN embedding])
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), lowest AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM lowest"""


def with_near_copies(vectors: DataFrame, offset: int = 10**9) -> DataFrame:
    """``vectors`` (vec_id, embedding) and three copies of each, every third component 1.1, 1.5 and 6 times as large.

    The first two link with their original and with each other, the third with none of them.
    """
    def copy(k: int, factor: float) -> DataFrame:
        stretched = F.transform("embedding", lambda x, i: F.when(i % 3 == 0, x.cast("double") * factor)
                                .otherwise(x.cast("double")))
        return vectors.select((F.col("vec_id") + k * offset).alias("vec_id"), stretched.alias("embedding"))

    return (vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
            .unionByName(copy(1, 1.1)).unionByName(copy(2, 1.5)).unionByName(copy(3, 6.0)))


NEAR_COPIES_SQL = NEAR_SQL.replace("WITH RECURSIVE v AS (", """WITH RECURSIVE planted AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings
  UNION ALL
  SELECT vec_id + 1000000000::BIGINT * k AS vec_id,
         [CASE WHEN i % 3 = 0 THEN embedding[i + 1]::DOUBLE * factor ELSE embedding[i + 1]::DOUBLE END FOR i IN range(len(embedding))]
  FROM embeddings, (VALUES (1, 1.1::DOUBLE), (2, 1.5::DOUBLE), (3, 6.0::DOUBLE)) c(k, factor)
), v AS (""").replace("FROM embeddings\n  WHERE len", "FROM planted\n  WHERE len").replace(
    "SELECT vec_id, vec_id AS other FROM embeddings", "SELECT vec_id, vec_id AS other FROM planted").replace("'nan'::FLOAT", "'nan'::DOUBLE")
