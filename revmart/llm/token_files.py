"""Token files: a concatenated id array with Elias-Fano document boundaries.

Documents are range-partitioned and sorted by id; each task encodes its
range and writes files of about ``file_ids`` ids. A file is written under an
attempt's own name and renamed, so a task that runs twice leaves the same
file; only files that the manifest names (written by Spark's committer)
count.

File, little-endian:

    "EFTK", version u16, bytes per id u16, documents u64, ids u64,
    null doc_ids u64, smallest doc_id i64,
    Elias-Fano of the n + 1 boundaries (0 first, the number of ids last),
    Elias-Fano of doc_id - smallest doc_id (documents with a doc_id),
    the ids, 2 or 4 bytes each.

Defined results: a null text is empty and gives the end id alone; rows that
share a doc_id follow one another, by text; null doc_ids come first; an
empty table gives no files and no rows; other columns are not read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revmart.llm.common import limited, materialise, shuffle_partitions
from revmart.llm.elias_fano import EliasFano
from revmart.llm.tokens import encoder as worker_encoder
from revmart.session import scratch_path

MAGIC = b"EFTK"
_HEAD = struct.Struct("<4sHHQQQq")
MANIFEST = "part long, seq long, file string, n_docs long, n_ids long"


class TokenFile:
    """One file's content: offsets by select, ids as an array."""

    def __init__(self, data: bytes) -> None:
        view = memoryview(data)
        magic, version, width, self.n_docs, self.n_ids, self.n_null, self.base = _HEAD.unpack_from(view)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token file")
        self.bounds, at = EliasFano.from_bytes(view, _HEAD.size)
        self.keys, at = EliasFano.from_bytes(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", self.n_ids, at)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + (self.keys.decode() + self.base).tolist()


def file_bytes(doc_ids: list[int | None], docs: list[bytes], wide: bool) -> bytes:
    """A file's content from ascending doc_ids (nulls first) and their ids as uint32 bytes."""
    lengths = np.array([len(d) // 4 for d in docs], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    known = np.array([i for i in doc_ids if i is not None], dtype=np.int64)
    base = int(known[0]) if len(known) else 0
    ids = np.frombuffer(b"".join(docs), "<u4").astype("<u4" if wide else "<u2")
    return b"".join((
        _HEAD.pack(MAGIC, 1, 4 if wide else 2, len(docs), len(ids), len(doc_ids) - len(known), base),
        EliasFano.encode(bounds).to_bytes(), EliasFano.encode((known - base).astype(np.uint64)).to_bytes(),
        ids.tobytes()))


def put(folder: str, name: str, data: bytes) -> None:
    """Write a file in the shared store so that it appears whole or not at all."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    attempt = f"{path}/_attempt-{uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        out.write(data)
    store.move(attempt, f"{path}/{name}")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, vocab_size: int,
                      drops_space: bool = False, file_ids: int = 2_000_000) -> DataFrame:
    """Write ``docs`` (doc_id, text) under ``folder``; returns the manifest (part, seq, file, n_docs, n_ids)."""
    spark = docs.sparkSession
    wide = max(vocab_size, end_id + 1) > 1 << 16
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_encoder(tokenizer, drops_space)
        part, seq = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held, keys, ids
            name = f"part-{part:06d}-{seq:06d}.tok"
            put(folder, name, file_bytes(keys, ids, wide))
            row = pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "file": name, "n_docs": len(keys), "n_ids": held}])
            keys, ids, held, seq = [], [], 0, seq + 1
            return row

        for batch in limited(batches, "text", 4_000_000):
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, blob in zip(doc_ids, encoder.encode(batch.column("text").to_pylist())):
                blob += end
                if keys and held + len(blob) // 4 > file_ids:
                    yield flush()
                keys.append(doc_id)
                ids.append(blob)
                held += len(blob) // 4
        if keys:
            yield flush()

    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
               .repartitionByRange(shuffle_partitions(spark), "doc_id")
               .sortWithinPartitions("doc_id", "text"))
    return materialise(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    # The ids before a file: those of the parts before its own (one row per part is summed up in a row),
    # and of the files before it in its part.
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy(F.col("part").alias("of")).agg(F.sum("n_ids").alias("n")).select(
        "of", F.coalesce(F.sum("n").over(before.orderBy("of")), F.lit(0)).alias("earlier"))
    inside = F.coalesce(F.sum("n_ids").over(before.partitionBy("part").orderBy("seq")), F.lit(0))
    starts = (manifest.select("file", "part", inside.alias("inside")).join(parts, F.col("part") == F.col("of"))
              .select("file", (F.col("earlier") + F.col("inside")).alias("first")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                tokens = TokenFile(content.as_buffer().to_pybytes())
                bounds = tokens.bounds.select_many(np.arange(tokens.n_docs + 1))
                ids = tokens.ids.astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([os.path.basename(path)] * tokens.n_docs, pa.string()),
                    pa.array(tokens.doc_ids(), pa.int64()),
                    pa.array(bounds[:-1], pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])], pa.int64()),
                ], ["file", "doc_id", "local", "n_tokens", "ids_crc32"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tok").load(folder)
             .select("path", "content"))
    rows = files.mapInArrow(read, "file string, doc_id long, local long, n_tokens long, ids_crc32 long")
    return (rows.join(starts, "file")
            .select("doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, tokenizer: str, end_id: int, vocab_size: int) -> DataFrame:
    """Write ``docs`` to a fresh folder of token files and read them back."""
    spark = docs.sparkSession
    if docs.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    folder = scratch_path(spark, "token-files")
    return read_token_files(spark, folder, write_token_files(docs, folder, tokenizer, end_id, vocab_size))
