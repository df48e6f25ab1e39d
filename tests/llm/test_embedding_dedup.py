from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from revmart.llm.components import components
from revmart.llm.embedding_dedup import (Layout, bucket_codes, cell_codes, layout, near_vectors, tables_and_bits, unit,
                                         unite)


def _union(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_components_against_union_find(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    pairs += [(i, i + 1) for i in range(500, 700)] + [(800, i) for i in range(801, 1000)] + [(3, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in components(df, "a", "b").collect()}
    want = _union(1000, pairs)
    assert all(got.get(i, i) == want[i] for i in range(1000))
    assert components(df.limit(0), "a", "b").collect() == []


def test_unite_against_union_find():
    rng = np.random.default_rng(1)
    label, pairs = np.arange(300), rng.integers(0, 300, (220, 2))
    for part in np.array_split(pairs, 5):
        unite(label, part[:, 0], part[:, 1])
    assert label.tolist() == _union(300, pairs.tolist())


def _vectors(rng):
    """Noise, tight groups, pairs near the threshold, copies."""
    rows = [rng.standard_normal(32) for _ in range(300)]
    for spread, size in ((0.05, 120), (0.25, 30), (0.45, 20)):
        center = rng.standard_normal(32)
        rows += [center + spread * rng.standard_normal(32) for _ in range(size)]
    rows += [rows[300]] * 40 + [3.0 * rows[301]]
    return np.array(rows)


@pytest.mark.parametrize("bucket_rows, block_rows", [(512, 2048), (32, 20)])
def test_links_against_brute_force(spark, bucket_rows, block_rows):
    X = _vectors(np.random.default_rng(2))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(X)], "vec_id long, embedding array<double>")
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    near = U @ U.T >= 0.9
    np.fill_diagonal(near, False)
    rows = near_vectors(df, bucket_rows=bucket_rows, block_rows=block_rows).orderBy("vec_id").collect()
    want = _union(len(X), np.argwhere(near).tolist())
    found = np.array([r.n_links for r in rows])
    assert (found <= near.sum(1)).all()  # none below the threshold
    assert found.sum() >= 0.99 * near.sum()
    assert [r.component_id for r in rows] == want
    assert [r.kept for r in rows] == [c == i for i, c in enumerate(want)]


def test_unusable_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e38, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit("x"))
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert len(out) == len(rows)
    assert [out[i][:2] for i in (1, 2, 10)] == [(2, 1)] * 3
    assert all(out[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))
    assert out[None] == (0, None, False)
    assert near_vectors(df.limit(0)).collect() == []


def test_tables_follow_the_recall():
    for n in (10, 10**5, 10**9):
        bits, tables = tables_and_bits(n, 0.9, 0.995, 512)
        p = 1 - np.arccos(0.9) / np.pi
        assert 1 - (1 - p**bits) ** tables >= 0.995


def test_near_copies_link_with_their_originals(spark):
    from revmart.llm.embedding_dedup import near_vectors, with_near_copies
    rows = [(i, [float((i * 37 + k * 11) % 101 - 50) for k in range(32)]) for i in range(40)]
    out = near_vectors(with_near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    got = {r.vec_id: r for r in out.collect()}
    assert len(got) == 160
    for i in range(40):
        assert got[10**9 + i].component_id == got[2 * 10**9 + i].component_id == got[i].component_id
        assert got[i].n_links >= 2


def test_vectors_are_dealt_to_few_cells(spark, monkeypatch):
    """What leaves for the groups is a few times the vectors, however many tables there are."""
    frame, made = type(spark.range(0)), []
    plain = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **b: made.append(plain(self, *a, **b)) or made[-1])
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(3).standard_normal((600, 16)))]
    near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), bucket_rows=4)
    moved = 0
    for df in made:
        if "vec" in df.columns:
            wide = [F.sum(F.octet_length(c)) for c, kind in df.dtypes if kind == "binary"]
            moved += sum(df.agg(*wide).first())
    assert tables_and_bits(600, 0.9, 0.995, 4)[1] > 15
    assert 600 * 16 * 8 <= moved <= 4 * 600 * 16 * 8


def test_layout_follows_recall_and_bytes():
    p = 1 - np.arccos(0.9) / np.pi
    for n, dim in ((10, 64), (10**5, 64), (2_880_000, 64), (10**9, 64), (10**6, 1536), (10**6, 2)):
        at = layout(n, n * (8 * dim + 512), 0.9, 0.995, 512, 96 << 20)
        inside = 1 - (1 - p**at.bits) ** at.tables
        assert 1 - (1 - p**at.cell_bits * inside) ** at.cell_tables >= 0.995
        assert n * (8 * dim + 512) / 2**at.cell_bits <= 96 << 20
        assert at.cell_bits + at.bits == tables_and_bits(n, 0.9, 0.995, 512)[0]
    assert layout(2_880_000, 2_880_000 * 1024, 0.9, 0.995, 512, 96 << 20).cell_tables <= 9  # 38 tables


@pytest.mark.parametrize("cell_bytes, block_rows", [  # one cell, several, several that are split
    (1 << 30, 3), (80_000, 2048), (80_000, 3), (12_000, 1)])  # of few block_rows: groups are put off and split further
def test_each_found_pair_counts_once(spark, cell_bytes, block_rows):
    X = _vectors(np.random.default_rng(4))
    copies = X[-42:]  # equal vectors are one class with several rows
    X = np.concatenate([X[:-41], copies[:1], copies[-1:]])
    U = unit(X)
    at = layout(len(X), len(X) * (8 * 32 + 512), 0.9, 0.995, 16, cell_bytes)
    cells = cell_codes(U, at, 11)
    codes = [c for t in range(at.cell_tables) for c in bucket_codes(U, cells, at, 11, t)]
    near = U @ U.T >= 0.9
    found = near & np.any([c[:, None] == c[None, :] for c in codes], axis=0)
    np.fill_diagonal(found, False)
    np.fill_diagonal(near, False)
    assert found.sum() >= 0.99 * near.sum()
    assert (at.cell_bits > 0) == (cell_bytes < 1 << 30) and isinstance(at, Layout)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(X)], "vec_id long, embedding array<double>")
    rows = near_vectors(df, bucket_rows=16, block_rows=block_rows, cell_bytes=cell_bytes).orderBy("vec_id").collect()
    same = (X[:, None] == X[None, :]).all(axis=2) & ~np.eye(len(X), dtype=bool)
    assert [r.n_links for r in rows] == (found | same).sum(axis=1).tolist()
    assert [r.component_id for r in rows] == _union(len(X), np.argwhere(found | same).tolist())
