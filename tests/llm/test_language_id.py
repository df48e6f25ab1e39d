from __future__ import annotations

import re

import zstandard

from pyspark.sql import functions as F

from revmart.llm.common import fold, table
from revmart.llm.language_id import CompressionClassifier, fill, identify, learn_dictionaries, predict_languages

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    out = identify(docs, fold("doc_id", 3) == 1)
    both = out.filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    n, right = both.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 250 and right / n >= 0.98
    assert out.count() == docs.count()


def test_cases(spark, make_docs):
    rows = [(i, "the cat sat on the mat " * 3, "en") for i in range(20)]
    rows += [(i, "der Hund und die Katze schlafen " * 3, "de") for i in range(20, 40)]
    rows += [(50, None, "en"), (51, "", None), (52, "123 !? 45", "en"), (53, "der Hund und die Katze " * 20_000, None),
             (54, "the cat sat on the mat", "en"), (54, "the cat sat on the mat", "en"), (None, "the cat sat on", None)]
    out = identify(make_docs(rows, extra=True), F.col("doc_id") == 54).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3 and by[52].score == 0
    assert (by[53].lang_pred, by[54].lang_pred, by[None].lang_pred) == ("de", "en", "en")
    assert all(0 <= r.score <= 1 for r in out)
    assert identify(make_docs([]), F.lit(False)).collect() == []
    unlabelled = identify(make_docs([(1, "a word", None)]), F.lit(False)).collect()
    assert [r.lang_pred for r in unlabelled] == ["und"]


def test_narrow_margins_are_rejected_and_sample_is_bounded(spark, make_docs):
    same = CompressionClassifier({"a": b"lorem ipsum dolor " * 9, "b": b"lorem ipsum dolor " * 9})
    assert same.predict("lorem ipsum dolor sit")[::2] == ("a", True)
    docs = make_docs([(i, "x" * 5000, "en") for i in range(50)]).withColumnRenamed("doc_id", "id")
    assert len(learn_dictionaries(docs, sample_texts=4, dict_bytes=1000)["en"]) <= 1000


def test_predictions_recounted_text_by_text(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.select("doc_id", "text", "lang", F.lit(False).alias("held_out"))
    content = learn_dictionaries(rows.withColumnRenamed("doc_id", "id"))
    got = {r.doc_id: r for r in predict_languages(rows, content).collect()}

    def size(data, lang):
        dictionary = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        frame = zstandard.ZstdCompressor(level=5, dict_data=dictionary, write_checksum=False, write_content_size=False,
                                         write_dict_id=False)
        return sum(len(frame.compress(data[a:a + 4096])) for a in range(0, len(data), 4096))

    for r in docs.collect():
        data = re.sub(r"[\W\d_]+", " ", (r.text or "").lower()).encode()
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
            continue
        sizes = {lang: size(data, lang) for lang in content}
        best = min(sizes.values())
        assert got[r.doc_id].lang_pred == min(lang for lang, n in sizes.items() if n == best)
        gap = (sorted(sizes.values())[1] - best) / best
        assert got[r.doc_id].rejected == (gap < 0.01)


def test_dictionary_is_filled_from_all_texts_and_all_of_each(make_docs):
    assert fill([b"a" * 10, b"b" * 50, b"c" * 50], 62) == b"a" * 10 + b"\n" + b"b" * 25 + b"\n" + b"c" * 25
    assert fill([b"a", b"b"], 100) == b"a\nb" and fill([], 9) == b""
    text = " ".join("abcdefghij"[i // 1000] * 5 for i in range(10_000))  # ten stretches
    docs = make_docs([(i, text, "en") for i in range(5)]).withColumnRenamed("doc_id", "id")
    content = learn_dictionaries(docs, sample_texts=5, dict_bytes=2000)["en"]
    assert 1900 <= len(content) <= 2000 and {b"aaaaa", b"ccccc", b"jjjjj"} <= set(content.split())
    assert content.count(b"\n") == 4


def test_texts_are_cut_before_they_are_exchanged(spark, make_docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = make_docs([(i, "the cat sat on the mat " * 100, "en") for i in range(2000)]).withColumnRenamed("doc_id", "id")
        plans = []
        collect = type(rows).collect
        type(rows).collect = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df)
        try:
            learn_dictionaries(rows, sample_texts=5, dict_bytes=1000)
        finally:
            type(rows).collect = collect
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    before_cut = plans[0].rsplit("substring", 1)[1]  # what is below the cut
    assert "SortMergeJoin" not in plans[0] and "BroadcastHashJoin" in before_cut
    assert "text" not in before_cut[before_cut.index("Exchange"):].split("Exchange hashpartitioning")[1].split("\n")[0]
