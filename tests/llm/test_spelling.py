"""Spelling variants, against strings with one letter left out."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from revmart.llm.queries import QUERIES
from revmart.llm.spelling import frequent_words, letter_runs, number_nodes, shared_nodes, spelling_variants
from tests.conftest import SF_SMALL

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}


def brute_variants(words, factor=5):
    near, alike = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            alike[i, w[:i], w[i + 1:]].add(w)
            if (shorter := w[:i] + w[i + 1:]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in alike.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= factor * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out)


@pytest.fixture(params=[True, False], ids=["coalesced", "many range partitions"])
def partitions(spark, request):
    """Without coalescing, tiny tables too are numbered in several range partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, str(request.param).lower())
    yield
    spark.conf.set(name, "true")


def _variants(spark, words):
    return spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"))


def test_variants_equal_brute_force(spark, partitions):
    rng = random.Random(11)
    words = {}
    for k in range(700):  # few letters: many neighbours, runs of one letter, equal counts, chains
        words["".join(rng.choices("aab", k=rng.randint(0, 9)))] = rng.choice([1, 1, 2, 5, 30, 150, 800, 5000])
        words["".join(rng.choices("éßzÿ", k=rng.randint(1, 5)))] = rng.choice([1, 3, 3, 20])
    words |= {"q" * 3000: 7, "q" * 2999: 40, "q" * 1500 + "x" + "q" * 1499: 2}
    got = _variants(spark, words)
    assert got.columns == COLUMNS
    want = brute_variants(words)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert any(root not in (word, form) for word, form, root, *_ in want)


def test_nodes_are_the_distinct_prefixes(spark, partitions):
    rng = random.Random(12)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 8))) for _ in range(500)})
    numbered = number_nodes(spark.createDataFrame([(w,) for w in words], "word string"), "word", "nodes").cache()
    same = {r["node"]: r["same"] for r in shared_nodes(numbered, "word", "nodes").collect()}
    rows = numbered.orderBy("seq").collect()
    assert [r["word"] for r in rows] == words
    names = defaultdict(set)
    for r in rows:
        for depth, node in enumerate(r["nodes"]):
            names[same.get(node, node)].add(r["word"][:depth])
    assert all(len(n) == 1 for n in names.values())  # a node is one prefix
    assert len(names) == len({w[:d] for w in words for d in range(len(w) + 1)})  # a prefix is one node


def test_no_words(spark):
    assert _variants(spark, {}).count() == 0


def test_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "spelling"), (None, "spelling " * 7), (5, "Spelling x spellin " * 40_000),
            (6, "y" * 100_000), (7, "spélling " * 5), (7, "spélling"), (8, "ÀÉ×÷ÿß " * 6)]
    words = frequent_words(letter_runs(make_docs(rows, extra=True)))
    got = {r["word"]: tuple(r) for r in spelling_variants(words).collect()}
    want = brute_variants(brute_words(rows))
    assert sorted(got.values()) == want
    assert got["spélling"][1:3] == ("spelling", "spelling")
    assert got["ÀÉ×÷ÿß"][3] == 6  # only A-Z change
    assert frequent_words(letter_runs(make_docs([]))).count() == 0


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = QUERIES["op12_spelling_variants"](spark, SF_SMALL)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == brute_variants(brute_words(rows))
