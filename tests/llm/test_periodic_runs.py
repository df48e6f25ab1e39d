"""Periodic runs, against every period tried at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from revmart.llm.periodic_runs import collapse, digests, periodic_runs, runs_of, suffix_order
from revmart.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute_runs(words, min_length=6, exponent=4):
    out, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            part = words[i:j + q]
            smaller = any(part[:-d] == part[d:] for d in range(1, q))
            if len(part) >= max(min_length, exponent * q) and not smaller:
                out.append((i, len(part), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    """The contract's row, from its words alone."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def _rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.mark.parametrize("min_length, exponent", [(6, 4), (4, 2), (9, 3)])
def test_runs_equal_brute_force(min_length, exponent):
    rng = random.Random(min_length)
    for _ in range(150):
        docs = []
        for _ in range(6):
            n, k = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 5, 30])
            words = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 3))
                words = words[:a] + [words[a + i % p] for i in range(n - a)]
            docs.append(words)
        assert runs_of(docs, min_length, exponent) == [brute_runs(d, min_length, exponent) for d in docs]


def test_suffix_order_equals_sorting():
    rng = random.Random(8)
    words = [rng.randrange(3) for _ in range(200)]
    order, lcp = suffix_order(np.array(words), np.full(200, 200))
    assert order.tolist() == sorted(range(200), key=lambda i: words[i:])
    for k in range(1, 200):
        a, b = words[order[k - 1]:], words[order[k]:]
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_runs_do_not_cross_documents():
    assert runs_of([[b"a"] * 5, [b"a"] * 5, [b"a"] * 6]) == [[], [], [(0, 6, 1)]]


def test_overlapping_runs_and_collapse():
    words = b"x a a a a a a b a b a b a b y".split()
    runs = runs_of([words])[0]
    assert runs == brute_runs(words) == [(1, 6, 1), (6, 8, 2)]
    assert collapse(words, runs) == "x a b y"


def test_long_texts_are_whole():
    words = [b"a", b"b", b"c"] * 70_000
    assert runs_of([words, [b"z"] * 100_000]) == [[(0, 210_000, 3)], [(0, 100_000, 1)]]


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "la " * 9), (4, "la " * 9), (5, "a\u00a0b a\u00a0b a\u00a0b a\u00a0b"),
            (6, "one two one two one two one two"), (7, "w " * 30_000), (None, "x x x x x x x")]
    rows += [(i, t) for i in range(100, 160) for t in ("p q r s t u v w x y", "k")]  # some are planted, n = 1 too
    found = digests(periodic_runs(make_docs(rows, extra=True)))
    assert found.columns == COLUMNS and found.count() == len(rows)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[1]["n_runs"] == 0 and by_id[1]["start"] is None
    assert by_id[1]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest() == by_id[3]["runs_sha256"]
    assert (by_id[4]["start"], by_id[4]["length"], by_id[4]["exponent_milli"]) == (0, 9, 9000)
    assert by_id[5]["n_runs"] == 0  # four words: U+00A0 is no white space here
    assert by_id[None]["length"] == 7
    assert digests(periodic_runs(make_docs([]))).count() == 0


def test_planting_equals_brute_force(make_docs):
    from revmart.llm.periodic_runs import with_planted_runs
    rows = [(i, t) for i in range(200, 320) for t in ("p q r s t u v w x y z a b c d e f g", "k", "", None)]
    got = digests(periodic_runs(with_planted_runs(make_docs(rows, extra=True))))
    assert _rows(got) == sorted((brute_row(i, t) for i, t in rows), key=str)


def test_query_against_brute_force(spark):
    texts = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: brute_row(r["doc_id"], r["text"]) for r in texts if len((r["text"] or "").split()) < 700}
    got = {r[0]: r for r in _rows(QUERIES["op13_periodic_runs"](spark, SF_SMALL))}
    assert len(got) == len(texts) and len(want) > 100
    assert {i: got[i] for i in want} == want
