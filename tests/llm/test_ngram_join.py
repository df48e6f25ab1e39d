from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from revmart.llm.ngram_join import (Shingler, _groups_of_sorted, _likely, candidate_pairs, jaccard_components,
                                    join_sets, linked, signature)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc_id -> (set size, smallest id reachable by links)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]) and find(i) != find(j):
                a, b = find(i), find(j)
                a, b = (a, b) if rows[a][0] <= rows[b][0] else (b, a)
                root[b] = a
    return sorted((rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows)))


def corpus(rng, n=60):
    vocab = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocab, k=60)
    rows = []
    for _ in range(n):
        base = rng.choices(vocab, k=rng.choice([1, 3, 5, 8, 60, 200]))
        if rng.random() < 0.4:
            base = base + passage
        rows.append(base)
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append(copy if rng.random() < 0.7 else copy[:-rng.randint(1, 1 + len(copy) // 6)] or copy)
    chain = rng.choices(vocab, k=120)  # links run along it, its ends do not link
    for _ in range(15):
        rows.append(list(chain))
        chain = chain[4:] + rng.choices(vocab, k=4)
    rng.shuffle(rows)
    return [(i * 3 % 1009, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"block": 4, "common_least": 2}])
def test_components_against_brute_force(make_docs, options):
    rows = corpus(random.Random(len(options)))
    rows += [(5000, ""), (5001, " "), (5002, "One two"), (5003, "one TWO"), (5004, "long " * 30_000),
             (5005, "long " * 20_000), (5006, "a b c d e f g h i"), (5007, "a b c d e f g h i j")]
    rows += [(6000 + i, rows[0][1]) for i in range(40)]
    out = jaccard_components(make_docs(rows + [(9000, None)], extra=True), **options).collect()
    assert sorted(map(tuple, out)) == brute(rows + [(9000, None)])


def test_null_ids_repeats_and_empty(make_docs):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "x")]
    out = sorted(map(str, (tuple(r) for r in jaccard_components(make_docs(rows)).collect())))
    assert out == sorted(map(str, [(None, 2, None), (1, 2, 1), (1, 2, 1), (2, 1, 2)]))
    assert jaccard_components(make_docs([])).collect() == []


def test_tree_finds_every_component():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(120):
        base = rng.integers(0, 1 << 62, rng.integers(1, 400)).astype(np.uint64)
        sets += [np.unique(base), np.unique(np.append(base[:len(base) - len(base) // 9], rng.integers(0, 9, 2)
                                                      .astype(np.uint64)))]
    label = list(range(len(sets)))
    for a, b in join_sets(sets):
        assert linked(sets[a], sets[b])
        x, y = sorted((label[a], label[b]))
        label = [x if v == y else v for v in label]
    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                assert label[i] == label[j]


def test_tree_prunes_unlike_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64)) for _ in range(300)]
    sizes = np.array([len(s) for s in sets])
    assert sum(len(i) for i, _ in candidate_pairs([signature(s) for s in sets], sizes)) == 0


def test_linked_sets_are_candidates_across_widths():
    rng = np.random.default_rng(2)
    sets = []
    for n in (200, 250, 256, 260, 300, 500, 520, 1000, 1030):
        base = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        sets += [base, base[:len(base) * 9 // 10], base[:len(base) * 81 // 100 + 1]]
    found = set()
    for i, j in candidate_pairs([signature(s) for s in sets], np.array([len(s) for s in sets])):
        found |= {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if linked(sets[i], sets[j])}
    assert want <= found and len(want) >= 18


def test_shingles_are_distinct_word_sequences():
    make = Shingler(5)
    for text in ("a b c d e a b c d e", "A b", "b A", "x " * 50, "a  b\tc\nd e f", "é É"):
        assert len(make(text)) == len(shingles(text))
    assert make("a b")[0] != make("b a")[0] and len(make(None)) == 0
    assert (make("a b c d e") == make("A B  c d E")).all()


def test_likely_rows_hold_all_that_are_asked_for(spark):
    docs = spark.range(-500, 5000).selectExpr("id AS doc_id", "'x' AS text")
    ids = spark.range(0, 400).selectExpr("id * 11 - 300 AS rep")
    for bits, most in ((1 << 27, 402), (1 << 10, 3000)):
        got = {r.doc_id for r in _likely(docs, ids, bits).collect()}
        assert {r.rep for r in ids.collect()} <= got and len(got) <= most
    assert _likely(docs, ids.limit(0)).count() == 0


def test_groups_across_batches():
    token, rep = [1, 2, 2, 2, 2, 3, 3, 4, 5, 5], [7, 3, 4, 5, 6, 1, 9, 8, 2, 2]
    want = {(3, 3), (3, 4), (3, 5), (3, 6), (1, 1), (1, 9)}
    for size in (1, 2, 3, 10):
        batches = [pa.RecordBatch.from_pydict({"token": token[i:i + size], "rep": rep[i:i + size]})
                   for i in range(0, 10, size)]
        got = {(a, b) for out in _groups_of_sorted(iter(batches)) for a, b in zip(*out.to_pydict().values())}
        assert got == want, size
