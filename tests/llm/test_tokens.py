"""Token files and packing, against one call of the tokenizer on each whole text."""

from __future__ import annotations

import inspect
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revmart.llm.elias_fano import EliasFano
from revmart.llm.packing import best_fit, encode_pieces, pack, pack_documents, sequences
from revmart.llm.token_files import TokenFile, file_bytes, read_token_files, token_files, write_token_files
from revmart.llm.tokens import Encoder, public_path
from revmart.session import scratch_path

BYTE, WORD = public_path("byte_bpe_50k.json"), public_path("word_bpe_49k.json")
BITS = [" ", "  ", "\n", "\t", "a", "foo", "Bar", "'s", "'", "é", "ß", "1", "23", "!", " ", "́", "Σ",
        "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "\x1c", "漢字", "🙂", "\r\n"]


def _direct(path, texts, end):
    t = Tokenizer.from_file(path)  # as it is
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


def _crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("path, drops", [(BYTE, False), (WORD, True)])
def test_encoder_equals_whole_text(path, drops):
    random.seed(1)
    texts = ["".join(random.choices(BITS, k=random.randint(0, 14))) for _ in range(3000)]
    got = Encoder(path, drops, cache_words=40).encode(texts)
    for text, ids, want in zip(texts, got, _direct(path, texts, 0)):
        assert np.frombuffer(ids, "<u4").tolist() == want[:-1], text


def test_elias_fano_round_trip_and_size():
    rng = np.random.default_rng(0)
    for values in ([], [0], [7], [0, 0, 0], [5] * 600, [3, 2**62], [2**57 + 1] * 3, np.sort(rng.integers(0, 10**9, 3000)),
                   np.cumsum(rng.integers(0, 3, 5000)), [0, 2**40]):
        values = np.array(values, dtype=np.int64)
        coded = EliasFano.encode(values)
        back, end = EliasFano.from_bytes(memoryview(coded.to_bytes()))
        assert end == len(coded.to_bytes())
        assert back.decode().tolist() == values.tolist()
        for i in range(0, len(values), 7):
            assert back.select(i) == values[i]
        some = rng.permutation(len(values))
        assert back.select_many(some).tolist() == values[some].tolist()
    bounds = np.cumsum(rng.integers(1, 2000, 10_000))
    assert len(EliasFano.encode(bounds).to_bytes()) * 8 < 14 * len(bounds)  # 64 in a plain table


def test_file_select_gives_documents():
    docs = [[1, 2], [], [50_000], list(range(700))]
    tf = TokenFile(file_bytes([None, -3, 4, 4], [np.array(d, dtype="<u4").tobytes() for d in docs], wide=False))
    assert tf.doc_ids() == [None, -3, 4, 4]
    assert [tf.document(i).tolist() for i in range(4)] == docs


ROWS = [(5, "the cat"), (3, None), (9, ""), (-2, "x " * 5000), (7, "Ärger und mehr"), (3, "again"), (None, "no id"),
        (7, "Ärger und mehr"), (100, "z" * 9000)]


def test_token_files_against_brute_force(spark, make_docs):
    rows = token_files(make_docs(ROWS, extra=True), BYTE, 2, 50_257).collect()
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for (doc_id, _), ids in zip(ordered, _direct(BYTE, [t for _, t in ordered], 2)):
        want.append((doc_id, at, len(ids), _crc(ids)))
        at += len(ids)
    key = lambda r: r[1]
    assert sorted(map(tuple, rows), key=key) == want
    assert token_files(make_docs([]), BYTE, 2, 50_257).collect() == []


def test_small_files_and_wide_ids(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"word{i} " * (i % 50)) for i in range(300)])
    folder = f"file://{tmp_path}/files"
    manifest = write_token_files(docs, folder, BYTE, 70_000, 70_001, file_ids=200)
    assert manifest.count() > 20
    rows = read_token_files(spark, folder, manifest).orderBy("doc_id").collect()
    at = 0
    for r, ids in zip(rows, _direct(BYTE, [f"word{i} " * (i % 50) for i in range(300)], 70_000)):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), _crc(ids))
        at += len(ids)


def test_best_fit_decreasing():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 101, 2000)
    bins, offsets, fills = best_fit(lengths, 100)
    for k, fill in enumerate(fills):
        inside = np.flatnonzero(bins == k)
        spans = sorted((offsets[i], offsets[i] + lengths[i]) for i in inside)
        assert spans[0][0] == 0 and spans[-1][1] == fill <= 100
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(fills) <= 1.02 * np.ceil(lengths.sum() / 100) + 1


def _check_layout(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= capacity
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    return len(by)


def test_tree_places_every_piece_once(spark):
    rng = np.random.default_rng(3)
    lengths = [int(n) for n in rng.integers(1, 400, 3000)]
    pieces = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)],
                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = pack(pieces, 1000, node_pieces=100).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
    assert _check_layout(rows, 1000) <= 1.02 * sum(lengths) / 1000 + 1


@pytest.mark.parametrize("low, high", [(510, 700), (300, 600), (900, 1000), (1000, 1000), (1, 3)])
def test_tree_ends_and_loses_little_where_bins_stay_underfull(spark, low, high):
    """Against one best fit over all pieces."""
    lengths = np.random.default_rng(low).integers(low, high + 1, 1500)
    pieces = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)],
                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = pack(pieces, 1000, node_pieces=200).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths.tolist()))
    assert _check_layout(rows, 1000) <= 1.03 * len(best_fit(lengths, 1000)[2]) + 1


def test_pack_documents_against_brute_force(spark, make_docs):
    rows = pack_documents(make_docs(ROWS, extra=True), WORD, 1, 64).collect()
    want = []
    for (doc_id, _), ids in zip(ROWS, _direct(WORD, [t for _, t in ROWS], 1)):
        want += [(doc_id, k, at, min(64, len(ids) - at), _crc(ids[at:at + 64]))
                 for k, at in enumerate(range(0, len(ids), 64))]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    _check_layout(rows, 64)
    assert pack_documents(make_docs([]), WORD, 1, 64).collect() == []


def test_sequences_hold_the_ids(spark, make_docs):
    docs = make_docs(ROWS)
    pieces = encode_pieces(docs, WORD, 1, 64, True, with_ids=True)
    placed = pack(pieces.drop("ids"), 64)
    out = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in sequences(pieces, placed).collect()}
    for r in placed.collect():
        ids = out[r.sequence_id][r.offset:r.offset + r.length]
        assert _crc(ids) == r.ids_crc32
    assert placed.select(F.sum("length")).first()[0] == sum(len(v) for v in out.values())


def test_the_read_path_takes_offsets_by_select(spark, make_docs):
    docs = make_docs([(i, "word " * (i % 5)) for i in range(600)])
    folder = scratch_path(spark, "select")
    manifest = write_token_files(docs, folder, BYTE, end_id=2, vocab_size=50_257, file_ids=200)
    want = sorted(map(tuple, read_token_files(spark, folder, manifest).collect()))
    rows = sorted((i, "word " * (i % 5)) for i in range(600))
    start = 0
    for got, (i, text), ids in zip(want, rows, _direct(BYTE, [t for _, t in rows], 2)):
        assert got == (i, start, len(ids), _crc(ids))
        start += len(ids)
    # the workers fork with this module: no unpacking of boundaries is left in the read path
    assert "bounds.select_many(" in inspect.getsource(read_token_files)
    assert "bounds.decode(" not in inspect.getsource(read_token_files)


def test_added_tokens_in_a_text_are_one_id(make_docs):
    text = "a <|endoftext|> b"
    assert np.frombuffer(Encoder(BYTE, False).encode([text])[0], "<u4").tolist() == [64, 220, 50256, 275]
    for path, drops in ((BYTE, False), (WORD, True)):
        assert np.frombuffer(Encoder(path, drops).encode([text])[0], "<u4").tolist() == _direct(path, [text], 0)[0][:-1]
