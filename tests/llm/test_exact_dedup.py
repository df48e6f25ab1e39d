from __future__ import annotations

import hashlib

import corpus_pipeline
from revmart.llm import queries
from revmart.llm.common import table
from revmart.llm.exact_dedup import DigestIndex, dedup_batch, keep_first

SF = "/root/testdata/sf0.001"


def _index(spark, tmp_path, name):
    return DigestIndex(spark, str(tmp_path / "index"), f"idx_{name}", buckets=4)


def _norm(text):
    return (text or "").encode().lower()


ROWS = [(1, "Abc"), (2, "aBC"), (3, "ÄBC"), (4, "äbc"), (5, None), (6, ""), (7, "x"), (7, "X"),
        (None, "abc"), (None, "only"), (None, "only"), (8, "z" * 200_000), (9, "Z" * 200_000)]


def test_groups_against_brute_force(spark, tmp_path, make_docs):
    rows = dedup_batch(make_docs(ROWS, extra=True), _index(spark, tmp_path, "a")).collect()
    assert len(rows) == len(ROWS)
    by_text = {}
    for doc_id, text in ROWS:
        by_text.setdefault(hashlib.sha256(_norm(text)).hexdigest(), []).append(doc_id)
    for r in rows:
        ids = by_text[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.keep_id == (max(known) if known else None)
        assert r.group_size == len(ids)
    kept = [(r.doc_id, r.text_sha256) for r in rows if r.kept]
    assert len(kept) == len(set(kept)) == len(by_text)


def test_later_batch_meets_the_index(spark, tmp_path, make_docs):
    index = _index(spark, tmp_path, "b")
    dedup_batch(make_docs([(1, "a"), (2, "b")]), index).collect()
    rows = {r.doc_id: r for r in dedup_batch(make_docs([(10, "A"), (11, "c"), (12, "C")]), index).collect()}
    assert (rows[10].kept, rows[10].keep_id) == (False, 1)
    assert (rows[11].kept, rows[12].kept) == (False, True)
    assert index.read().count() == 3


def test_batch_run_twice_decides_alike(spark, tmp_path, make_docs):
    index = _index(spark, tmp_path, "c")
    docs = make_docs(ROWS)
    first = sorted(map(str, dedup_batch(docs, index).collect()))
    assert sorted(map(str, dedup_batch(docs, index).collect())) == first
    assert index.read().count() == len({_norm(t) for _, t in ROWS})


def test_index_survives_its_session_entry(spark, tmp_path, make_docs):
    index = _index(spark, tmp_path, "d")
    dedup_batch(make_docs([(1, "a")]), index).collect()
    spark.sql("DROP TABLE idx_d")  # external: the files stay
    again = _index(spark, tmp_path, "d2")
    assert [r.kept for r in dedup_batch(make_docs([(2, "a")]), again).collect()] == [False]


def test_sort_merge_anti_join_reads_index_without_shuffle(spark, tmp_path, make_docs):
    index = _index(spark, tmp_path, "e")
    new = spark.range(10).selectExpr("cast(cast(id as string) as binary) digest", "id keep_id")
    plan = new.join(index.read().select("digest").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "LeftAnti" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_keep_first_and_empty(spark, tmp_path, make_docs):
    docs = make_docs(ROWS + [(7, "X")], extra=True)
    kept = keep_first(docs, _index(spark, tmp_path, "f"))
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({_norm(t) for _, t in ROWS})
    assert {r.doc_id for r in rows if r.text and r.text.lower() == "abc"} == {2}
    assert dedup_batch(make_docs([]), _index(spark, tmp_path, "g")).collect() == []


def test_batches_decide_as_one(spark, tmp_path, make_docs):
    docs = make_docs(ROWS, extra=True)
    one, three = (sorted(map(str, dedup_batch(docs, _index(spark, tmp_path / str(n), f"h{n}"), batches=n).collect()))
                  for n in (1, 3))
    assert one == three
    nulls = make_docs([(None, "a"), (None, "A"), (None, "b")])
    rows = dedup_batch(nulls, _index(spark, tmp_path / "n", "hn"), batches=3).collect()
    assert sorted(r.kept for r in rows) == [False, True, True]


def test_registered_callers_join_a_filled_index(spark, monkeypatch):
    held, add = [], DigestIndex.add

    def seen(self, candidates):
        held.append(self.read().count())
        add(self, candidates)

    monkeypatch.setattr(DigestIndex, "add", seen)
    docs = table(spark, SF, "documents")
    best = {}
    for r in docs.select("doc_id", "text").collect():
        best[_norm(r.text)] = max(best.get(_norm(r.text), r.doc_id), r.doc_id)
    kept = {r.doc_id for r in queries.op4_exact_dedup(spark, SF).collect() if r.kept}
    assert held[0] == 0 < held[1] < held[2]
    assert kept == set(best.values())
    held.clear()
    assert {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, SF).collect()} == kept
    assert held[0] == 0 < held[1] < held[2]
