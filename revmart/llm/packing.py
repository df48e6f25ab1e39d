"""Hierarchical residual packing: best fit in every partition, then up a tree.

Pieces are dealt evenly over leaf nodes of about ``node_pieces``. Each node
packs its items best-fit decreasing; bins that are nearly full are finished.
All others become items of their filled length and are dealt anew over so
many parent nodes that each holds about ``node_pieces`` pieces again, where
they are best-fitted among bins of other nodes. So it goes on to one root,
or to a level of more than half as many nodes as the one below: there bins
hardly merge any more, and as every node holds a random share of all, meeting
still others would not help. That level's bins are all finished. A node's
memory is bounded, and no bin is left out of a level.

Defined results: a null text is empty and gives the end id alone; a
document longer than a sequence is cut into full pieces and a last, shorter
one; repeated rows are packed each; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import limited, materialise
from revmart.llm.tokens import encoder as worker_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", node long, bin long, offset long, fill long, done boolean"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and offset, and the bins' fill.

    Bins stand in a stack per free space; a sorted list of the free spaces
    in use gives the tightest bin that still fits.
    """
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    fills: list[int] = []
    stacks: dict[int, list[int]] = {}
    spaces: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = bisect_left(spaces, n)
        if at == len(spaces):
            k = len(fills)
            fills.append(0)
        else:
            space = spaces[at]
            k = stacks[space].pop()
            if not stacks[space]:
                del stacks[space]
                spaces.pop(at)
        bins[i], offsets[i] = k, fills[k]
        fills[k] += n
        if space := capacity - fills[k]:
            if space not in stacks:
                spaces.insert(bisect_left(spaces, space), space)
                stacks[space] = []
            stacks[space].append(k)
    return bins, offsets, np.array(fills, dtype=np.int64)


def encode_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, drops_space: bool,
                  with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 (and ids: uint32 bytes)."""
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, drops_space)
        for batch in limited(batches, "text", 4_000_000):
            out: list[list] = [[] for _ in range(6)]
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(),
                                    encoder.encode(batch.column("text").to_pylist())):
                blob += end
                for k, first in enumerate(range(0, len(blob), step)):
                    ids = blob[first:first + step]
                    for column, value in zip(out, (doc_id, k, first // 4, len(ids) // 4, zlib.crc32(ids), ids)):
                        column.append(value)
            arrays = [pa.array(v, t) for v, t in zip(out, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(arrays if with_ids else arrays[:5], names if with_ids else names[:5])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        encode, PIECES + ", ids binary" * with_ids)


def _pack_node(capacity: int, full: int, level: int, last: bool):
    """Packs one node's bins (rows that share ``bin``) as items; ``done`` marks the rows of finished bins."""
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        node = key[0].as_py()
        # The group's rows can come in any order; sorting makes a retried task place them alike.
        table = table.sort_by([(c, "ascending") for c in
                               ("bin", "offset", "doc_id", "piece", "ids_crc32")])
        row_bin = table.column("bin").to_numpy()
        _, first, row_item = np.unique(row_bin, return_index=True, return_inverse=True)
        bins, offsets, fills = best_fit(table.column("fill").to_numpy()[first], capacity)
        up = (fills < full) & (not last)
        row = bins[row_item]
        columns = {
            "node": np.full(len(row), node, dtype=np.int64),
            "bin": (level << 58) | (node << 24) | row,
            "offset": table.column("offset").to_numpy() + offsets[row_item],
            "fill": fills[row], "done": ~up[row]}
        for name, values in columns.items():
            at = table.schema.get_field_index(name)
            table = table.set_column(at, name, pa.array(values))
        return table

    return pack


def pack(pieces: DataFrame, capacity: int, node_pieces: int = 50_000, nearly_full: float = 0.995) -> DataFrame:
    """Place pieces in sequences: the pieces' columns, sequence_id and offset.

    Every level is written before the next one reads it, so a lost executor
    costs one level's tasks. Each level but the last has at most half the
    nodes of the one below.
    """
    pieces = materialise(pieces, "pieces")
    nodes = max(1, -(-pieces.count() // node_pieces))
    full = int(capacity * nearly_full)
    rows = (pieces.withColumn("node", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(nodes)))
            .withColumn("bin", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
            .withColumn("fill", F.col("length")).withColumn("done", F.lit(False)))
    finished, level, last = [], 0, nodes == 1
    while True:
        placed = materialise(rows.groupBy("node").applyInArrow(
            _pack_node(capacity, full, level, last), PLACED), f"packed-{level}")
        finished.append(placed.filter("done"))
        left = 0 if last else placed.filter("not done").count()
        if not left:
            break
        parents = -(-left // node_pieces)
        last = parents == 1 or parents > nodes // 2
        nodes, level = parents, level + 1
        rows = placed.filter("not done").withColumn("node", F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(nodes)))
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def sequences(pieces_with_ids: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids (uint32 little-endian bytes)."""
    key = ["doc_id", "piece", "ids_crc32"]
    ids = pieces_with_ids.dropDuplicates(key).select(*(F.col(k).alias(f"_{k}") for k in key), "ids")
    joined = placed.join(ids, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return (joined.groupBy("sequence_id")
            .agg(F.sum("length").alias("n_tokens"),
                 F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", "n_tokens", F.concat_ws("", F.transform("parts", lambda p: F.hex(p["ids"])))
                    .alias("hex"))
            .select("sequence_id", "n_tokens", F.unhex("hex").alias("ids")))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
                   drops_space: bool = True) -> DataFrame:
    return pack(encode_pieces(docs, tokenizer, end_id, capacity, drops_space), capacity)
