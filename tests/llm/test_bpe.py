"""BPE by contiguous rank arrays, against an untouched tokenizer of the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from revmart.llm.bpe import SHORT, BytePairs, RankTable, decode_ids, digests, encode_texts, merge_long, merge_short, round_trip
from revmart.llm.queries import QUERIES
from revmart.llm.tokens import public_path
from tests.conftest import SF_SMALL

PATH = public_path("byte_bpe_50k.json")
BITS = [" ", "  ", "\n", "\t", "a", "foo", "Bar", "'s", "'", "é", "ß", "1", "23", "!", " ", "́", "Σ", "\x1c",
        "<|endoftext|>", "<|endo", "漢字", "🙂", "\r\n", "՘", "\U00011de0", "x" * 70, "ab" * 100, "​", "\x85", " É", "ª", "ⅷ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def pairs():
    return BytePairs(PATH, cache_pieces=200)


def _ids(blob):
    return np.frombuffer(blob, "<u4").tolist()


def test_encode_equals_library(library, pairs):
    random.seed(3)
    texts = ["".join(random.choices(BITS, k=random.randint(0, 14))) for _ in range(4000)]
    texts += ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", " ", "\n", "a" * 5000, "!?" * 3000]
    for first in range(0, len(texts), 500):
        part = texts[first:first + 500]
        for text, blob, want in zip(part, pairs.encode(part), library.encode_batch(part, add_special_tokens=False)):
            assert _ids(blob) == want.ids, text


def test_decode_equals_library(library, pairs):
    random.seed(4)
    for _ in range(3000):  # mostly no UTF-8; 50257 and on are outside the vocabulary
        ids = [random.randrange(50_300) for _ in range(random.randint(0, 9))]
        assert pairs.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_matrix_and_heap_agree_and_boundaries_cut_the_word():
    table = RankTable(PATH)
    rng = random.Random(5)
    words = [bytes(rng.choices(b"theraionst aA1!\xc3\xa9", k=rng.randint(1, SHORT))) for _ in range(2000)]
    ids, bounds, counts = merge_short(table, words)
    for word, row, starts, n in zip(words, ids, bounds, counts):
        row, starts = row[:n].tolist(), starts[:n].tolist()
        assert row == merge_long(table, word)
        assert [table.bytes[i] for i in row] == [word[a:b] for a, b in zip(starts, [*starts[1:], len(word)])]


def test_odd_rows(make_docs, spark, library):
    texts = {1: None, 2: "", 3: "same text", 4: "same text", 5: "word " * 60_000, 6: "z" * 200_000, 7: "\n\n  \t x"}
    docs = make_docs([(i, t) for i, t in texts.items()] + [(3, "same text")], extra=True)
    rows = digests(decode_ids(encode_texts(docs, PATH), PATH)).collect()
    assert len(rows) == 8
    for row in rows:
        text = texts[row["doc_id"]] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, digests(round_trip(docs, PATH)).collect()), key=str)
    nulls = spark.createDataFrame([(1, None), (2, [50256, 50300]), (3, [])], "doc_id long, ids array<int>")
    assert [r["text"] for r in decode_ids(nulls, PATH).collect()] == ["", "<|endoftext|>", ""]
    empty = digests(decode_ids(encode_texts(make_docs([]), PATH), PATH))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_query_against_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_bpe"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        RankTable(public_path("word_bpe_49k.json"))
