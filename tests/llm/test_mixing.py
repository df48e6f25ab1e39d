from __future__ import annotations

import random

import duckdb

from revmart.llm.mixing import MIX_SQL, apportion, mix_documents, mixed_texts


def _targets(sizes: dict) -> dict:
    """Share by weight; what exceeds three times a size is shared again, until none does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        w = sum(weight[s] for s in order if s not in stopped)
        target = {s: 3.0 * sizes[s] if s in stopped else rest * weight[s] / w for s in order}
        over = {s for s in order if s not in stopped and target[s] >= 3 * sizes[s]}
        if not over:
            return target
        stopped |= over


def _rows(n, seed):
    rng = random.Random(seed)
    sources = ["a", "b", "B", "ü", "", None, "tiny"]
    rows = []
    for i in range(n):
        src = "tiny" if i == 0 else rng.choice([*sources[:-1], "a", "a"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 40, 900])) if src != "tiny" else "one", "en", src))
    return rows + [(n, None, None, "only null"), (5, "a\tb\x1fc d", "en", "a"), (None, "x y", None, "b")]


def test_targets_and_takings_against_brute_force(make_docs):
    rows = _rows(400, 1)
    out = mix_documents(make_docs(rows, extra=True)).collect()
    size = lambda t: len(t.encode().split()) if t else 0
    assert sorted(r["size"] for r in out) == sorted(size(r[1]) for r in rows)
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    want = _targets(sizes)
    by_id = {r[0]: r[3] for r in rows if r[0] is not None and r[0] != 5}
    taken: dict = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r["size"]
        if r.doc_id in by_id:
            assert r.source_size == sizes[by_id[r.doc_id]]
            assert abs(r.target - want[by_id[r.doc_id]]) < 1e-6 * max(1, r.target)
        src = (r.source_size, r.target)
        taken[src] = taken.get(src, 0) + r.taken
    for (_, target), got in taken.items():
        assert abs(got - target) <= 0.01 * target + 48
    again = mix_documents(make_docs(rows)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_sql_gives_the_same_rows(make_docs):
    docs = make_docs(_rows(300, 2))
    con = duckdb.connect()
    con.register("docs", docs.toPandas().astype({"doc_id": "Int64"}))
    want = con.sql(MIX_SQL.format(docs="docs") ).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in mix_documents(docs).collect())


def test_apportion_equals_all_quotients(spark):
    rng = random.Random(3)
    rows = [(g, i, rng.choice([0.0, rng.random(), 100 * rng.random(), 7.0]), seats)
            for g, seats in enumerate([0, 1, 5, 100, 997]) for i in range(12)]
    df = spark.createDataFrame(rows, "g int, i int, w double, seats long")
    got = {(r.g, r.i): r.quota for r in apportion(df, ["g"], ["i"], "w", "seats").collect()}
    for g, seats in enumerate([0, 1, 5, 100, 997]):
        q = sorted((-w / (2 * k + 1), i) for gg, i, w, _ in rows if gg == g and w > 0 for k in range(seats))[:seats]
        for i in range(12):
            assert got[g, i] == sum(1 for _, j in q if j == i)


def test_mixed_texts_hold_what_is_taken(make_docs):
    docs = make_docs([(i, f"{i} " + "w " * (i % 90), "en", f"s{i % 4}") for i in range(200)], extra=True)
    out = mixed_texts(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mix_documents(docs).collect() if r.taken}
    got: dict = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    assert got == taken


def test_empty_and_wordless(make_docs, spark):
    assert mix_documents(make_docs([])).collect() == []
    assert [(r.taken, r.target) for r in mix_documents(make_docs([(1, None), (2, " ")])).collect()] == [(0, 0.0)] * 2


def test_no_python_in_the_plan(make_docs):
    plan = mix_documents(make_docs(_rows(50, 4)))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian"))
