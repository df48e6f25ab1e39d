"""run() against the stages' rules, by brute force on the smallest tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revmart.llm.common import fold, table
from revmart.llm.mixing import mix_documents
from revmart.llm.tokens import public_path
from revmart.llm.toxicity import toxicity
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    frames, current = [], docs
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, SF).persist()
        frames.append([r.asDict() for r in current.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert current.columns == docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    scored = toxicity(docs, table(spark, SF, "labels"), fold("doc_id", 3) == 1)
    clean = {r.doc_id for r in scored.filter("predicted = 0").collect()}
    assert {r["doc_id"] for r in frames[0]} == clean and len(frames[0]) == len(clean)

    newest: dict = {}
    for i in clean:
        key = (rows[i].text or "").encode().lower()
        newest[key] = max(i, newest.get(key, i))
    assert sorted(r["doc_id"] for r in frames[1]) == sorted(newest.values())

    want = [i for i, _, c in brute([(i, rows[i].text) for i in newest.values()]) if i == c]
    assert sorted(r["doc_id"] for r in frames[2]) == want

    kept = docs.filter(F.col("doc_id").isin(want))
    taken = {r.doc_id: r.taken for r in mix_documents(kept).collect() if r.taken}
    got: dict = {}
    for r in frames[3]:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].encode().split())
    assert got == taken

    t = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    total = sum(len(t.encode(r["text"], add_special_tokens=False).ids) + 1 for r in frames[3])
    assert sum(r["length"] for r in frames[4]) == total
    by: dict = {}
    for r in frames[4]:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["offset"] + r["length"]))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 4096
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(by) <= total / 4096 * 1.1 + 1


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


def test_empty_and_odd_documents(spark, make_docs, tmp_path):
    """What each stage makes of nulls, empty and very long texts, repeated rows and ties."""
    sf = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    odd = [(1, None, None, None), (2, "", "en", ""), (3, "one two", "en", "a"), (3, "one two", "en", "a"),
           (None, "no id at all here now", "en", "a"), (4, "long " * 30_000, None, "b"), (5, "ONE two", "en", "a"),
           (6, "one two", "en", "a")]
    seen = {}
    for rows in ([], odd):
        current = make_docs(rows)
        for name, stage in corpus_pipeline.STAGES:
            current = stage(spark, current, sf)
            seen[name] = current.collect()
            assert rows or not seen[name]
    ids = lambda name: sorted((r["doc_id"] for r in seen[name]), key=str)
    assert ids("toxicity") == [1, 2, 3, 3, 4, 5, 6, None]  # one label only: nothing is toxic
    assert ids("exact_dedup") == [2, 4, 6, None]  # the largest id of null and empty, and of "one two"
    assert ids("ngram_jaccard_join") == [2, 4, 6, None]  # no five words in common
    assert set(ids("mix_sources")) <= {4, 6, None} and 4 in ids("mix_sources")
    assert {r["doc_id"] for r in seen["best_fit_packing"]} == set(ids("mix_sources"))


def test_columns_with_the_names_used_inside_are_kept(spark, make_docs):
    """Each stage but the last returns the columns of documents, with their values."""
    names = ["_toxicity", "_id", "_digest", "_digest_of", "_dropped", "row", "row_id", "rep", "score", "digest_of",
             "component_id", "keep_id", "n", "label", "id", "size", "taken"]
    rows = [(i, f"some words of text number {i} that are long enough", "en", "s") for i in range(20)]
    docs = make_docs([*rows, (20, rows[3][1].upper(), "en", "s")])
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{k}:"), F.col("doc_id").cast("string")))
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, SF)
        assert current.columns == docs.columns, name
        got = current.collect()
        assert got, name
        for r in got:
            assert all(r[c] == f"{k}:{r['doc_id']}" for k, c in enumerate(names)), name
        if name == "exact_dedup":
            assert 3 not in {r["doc_id"] for r in got} and 20 in {r["doc_id"] for r in got}
    assert corpus_pipeline.STAGES[-1][1](spark, current, SF).count() >= 1
