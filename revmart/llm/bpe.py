"""Byte-level BPE encoding and decoding by contiguous rank arrays.

A word (a pre-token of the tokenizer) is held as its part boundaries, the
parts' ids and the ranks of adjacent parts, side by side in arrays. The scan
for the minimum finds the merge of lowest rank (leftmost of equals), the
boundary between its two parts is deleted by moving the rest of the array up
by one, and only the ranks of the two neighbours are looked up anew. The
arrays of all new words of a batch that have about the same length are the
rows of one numpy matrix, so one step serves thousands of words. Words of
more than ``SHORT`` bytes would take time with the square of their length;
they merge by a heap over linked parts, with the same result.

Vocabulary, merges and added tokens are read from the tokenizer's file,
whose path is a parameter; the ``tokenizers`` library is not used. Encoding
cuts a text at added tokens, cuts the rest into words, and keeps the ids of
what stands between two spaces in a bounded cache of the worker process.
Decoding joins the ids' bytes; bytes that are no UTF-8 become U+FFFD and ids
outside the vocabulary give nothing, as the library does.

Defined results: a null or empty text has no ids and decodes to the empty
text; very long texts and words are encoded whole; repeated rows are encoded
each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import limited

#: Words of more bytes merge by a heap.
SHORT = 64
#: No merge.
_NONE = np.iinfo(np.int32).max
#: Fixed value: the pattern that cuts text into words, public with the vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space before a space: such texts cannot be cut at every space.
_RUN = regex.compile(r"\s ")
_BEYOND_LATIN_1 = regex.compile(r"[^\x00-\xff]")


def byte_alphabet() -> str:
    """The character that stands for each byte: itself where it is printable Latin-1, else from U+0100 on."""
    free = iter(range(256, 512))
    return "".join(chr(b) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173 else chr(next(free)) for b in range(256))


class RankTable:
    """Vocabulary and merges of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
                 and not cutter.get("add_prefix_space") and not spec["normalizer"]
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                    "ignore_merges"))
                 and not any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word")))
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max(*vocab.values(), *self.added.values())
        alphabet = byte_alphabet()
        self.byte_ids = np.array([vocab[c] for c in alphabet], dtype=np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.key_ranks = np.append(order, 0).astype(np.int32)
        #: rank -> id of the merged part
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        #: id -> bytes
        to_byte = {c: b for b, c in enumerate(alphabet)}
        self.bytes = [b""] * self.size
        for token, i in [*vocab.items(), *self.added.items()]:
            known = all(c in to_byte for c in token)
            self.bytes[i] = bytes(map(to_byte.__getitem__, token)) if known else token.encode()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of adjacent ids, ``_NONE`` where there is none (or an id is -1)."""
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, keys)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.key_ranks[at], _NONE)


def merge_short(table: RankTable, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and boundaries of words of at most ``SHORT`` bytes, one matrix row each, and the rows' counts.

    Row i holds ``count[i]`` parts: ids[i, k], and bounds[i, k] is the byte
    where part k begins. The last column of ids and ranks is always empty, so
    that every part has a right neighbour to look at.
    """
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    width = int(sizes.max()) + 1
    at = np.arange(width, dtype=np.int16)
    filled = at < sizes[:, None]
    all_ids = np.full((len(words), width), -1, dtype=np.int32)
    all_ids[filled] = table.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    all_bounds = np.where(filled, at, -1).astype(np.int16)
    rows, ids, bounds = np.arange(len(words)), all_ids, all_bounds
    ranks = np.full(ids.shape, _NONE, dtype=np.int32)
    ranks[:, :-1] = table.ranks(ids[:, :-1], ids[:, 1:])
    while len(rows):
        best = ranks.argmin(axis=1)  # the first of equals: the leftmost
        each = np.arange(len(rows))
        rank = ranks[each, best]
        live = rank != _NONE
        if not live.all():  # finished words leave
            all_ids[rows[~live], :ids.shape[1]] = ids[~live]
            all_bounds[rows[~live], :ids.shape[1]] = bounds[~live]
            rows, ids, bounds, ranks, best, rank = (x[live] for x in (rows, ids, bounds, ranks, best, rank))
            each = each[:len(rows)]
            if not len(rows):
                break
        # The boundary behind the left part goes: what follows moves up by one.
        ids[each, best] = table.merged[rank]
        moved = at[None, :-1] > best[:, None]
        for array, empty in ((ids, -1), (bounds, -1), (ranks, _NONE)):
            np.copyto(array[:, :-1], array[:, 1:].copy(), where=moved)
            array[:, -1] = empty
        new = ids[each, best]
        ranks[each, best] = table.ranks(new, ids[each, best + 1])
        inner = best > 0
        ranks[each[inner], best[inner] - 1] = table.ranks(ids[each[inner], best[inner] - 1], new[inner])
    return all_ids, all_bounds, (all_ids >= 0).sum(axis=1)


def merge_long(table: RankTable, word: bytes) -> list[int]:
    """Ids of one word of any length: a heap of merges (rank, place) over linked parts."""
    ids = table.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    first = table.ranks(np.array(ids[:-1], dtype=np.int32), np.array(ids[1:], dtype=np.int32))
    heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first != _NONE).tolist()]
    heapq.heapify(heap)
    known: dict[tuple[int, int], int] = {}

    def push(i: int) -> None:
        j = after[i]
        if j < n:
            pair = ids[i], ids[j]
            if pair not in known:
                known[pair] = int(table.ranks(np.array(pair[:1], dtype=np.int32), np.array(pair[1:], dtype=np.int32))[0])
            if known[pair] != _NONE:
                heapq.heappush(heap, (known[pair], i, *pair))

    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue  # one of the parts has merged since
        ids[i], ids[j] = int(table.merged[rank]), -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [i for i in ids if i >= 0]


class BytePairs:
    """``encode(texts)`` and ``decode(ids)``; at most ``cache_pieces`` pieces are kept from batch to batch."""

    def __init__(self, path: str, cache_pieces: int = 500_000) -> None:
        self.table = RankTable(path)
        self.words = regex.compile(WORDS)
        added = sorted(self.table.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.added_ids = {t: np.array([i], dtype="<u4").tobytes() for t, i in self.table.added.items()}
        self.cache_pieces = cache_pieces
        self.cache: dict[str, bytes] = dict(self.added_ids)

    def cut(self, text: str) -> list[str]:
        """Words of a text without added tokens."""
        if text.isalpha() or text[:1] == " " and text[1:].isalpha():
            return [text]
        if not text.isascii() and _BEYOND_LATIN_1.search(text):
            # Characters that newer Unicode versions assigned count as neither letter nor digit.
            strange = {c for c in set(text) if unicodedata.category(c) == "Cn"}
            if strange:
                alike = text.translate({ord(c): "" for c in strange})
                return [text[m.start():m.end()] for m in self.words.finditer(alike)]
        return self.words.findall(text)

    def merge(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids, as little-endian uint32 bytes, of distinct words."""
        out: dict[str, bytes] = {}
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            data = word.encode("utf-8", "replace")
            if len(data) > SHORT:
                out[word] = np.array(merge_long(self.table, data), dtype="<u4").tobytes()
            else:
                by_size.setdefault(-(-len(data) // 4), []).append((word, data))
        for alike in by_size.values():
            for first in range(0, len(alike), 16_384):
                part = alike[first:first + 16_384]
                ids, _, counts = merge_short(self.table, [data for _, data in part])
                blob = ids[ids >= 0].astype("<u4").tobytes()
                ends = (4 * np.cumsum(counts)).tolist()
                for (word, _), a, b in zip(part, [0, *ends], ends):
                    out[word] = blob[a:b]
        return out

    def _fill(self, pieces: set[str]) -> None:
        new = pieces.difference(self.cache)
        if len(self.cache) + len(new) > self.cache_pieces:
            self.cache = {p: self.cache[p] for p in pieces if p in self.cache} | self.added_ids
        cuts = {p: self.cut(p) for p in new}
        ids = self.merge(set().union(*cuts.values()))
        for piece, words in cuts.items():
            self.cache[piece] = ids[words[0]] if len(words) == 1 else b"".join([ids[w] for w in words])

    def _pieces(self, text: str) -> list[str]:
        """Pieces that can be encoded one by one: a space behind something else always begins a word."""
        if _RUN.search(text):
            return self.cut(text)
        head, *rest = text.split(" ")
        return ([head] if head else []) + [" " + p for p in rest]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian uint32 bytes."""
        cuts: list[list[str]] = []
        for text in texts:
            if text and self.added and self.added.search(text):
                # Every second part is an added token; no other piece can be equal to one.
                cuts.append([p for k, part in enumerate(self.added.split(text))
                             for p in ([part] if k % 2 else self._pieces(part))])
            else:
                cuts.append(self._pieces(text) if text else [])
        self._fill(set().union(*cuts))
        get = self.cache.__getitem__
        return [b"".join(map(get, cut)) for cut in cuts]

    def decode(self, ids: list[int]) -> str:
        table, size = self.table.bytes, self.table.size
        if ids and not 0 <= min(ids) <= max(ids) < size:
            ids = [i for i in ids if 0 <= i < size]
        return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def byte_pairs(path: str) -> BytePairs:
    """The worker process's tables and cache: they last from task to task."""
    return BytePairs(path)


def _encoded(pairs: BytePairs, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch's texts in a row, and where each text's ids begin (and the last ones end)."""
    blobs = pairs.encode(batch.column("text").to_pylist())
    return np.frombuffer(b"".join(blobs), dtype="<u4"), np.cumsum([0, *map(len, blobs)]) // 4


def _id_lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))


def _decoded(pairs: BytePairs, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    flat, bounds = ids.tolist(), ends.tolist()
    return pa.array([pairs.decode(flat[a:b]) for a, b in zip(bounds, bounds[1:])], pa.string())


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))


def encode_texts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (array of int)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(tokenizer)
        for batch in limited(batches, "text", 3_000_000):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _id_lists(*_encoded(pairs, batch))], ["doc_id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Per row of (doc_id, ids; null: none): doc_id, ids, text."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(tokenizer)
        for batch in batches:
            lists = batch.column("ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False)  # leaves null lists out
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, _decoded(pairs, ids, ends)],
                                             ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode_ids(encode_texts(docs))`` in one pass over the rows: doc_id, ids, and the text decoded from them."""
    def there_and_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(tokenizer)
        for batch in limited(batches, "text", 3_000_000):
            ids, ends = _encoded(pairs, batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _id_lists(ids, ends), _decoded(pairs, ids, ends)], ["doc_id", "ids", "text"])

    return _rows(docs, id_col, text_col).mapInArrow(there_and_back, "doc_id long, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the comma-joined ids and of the decoded text."""
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
