from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from revmart.llm import gru
from revmart.llm.common import fold, table
from revmart.llm.toxicity import STRIDE, WINDOW, Scorer, spread, toxicity, windows


def test_gradients_against_differences():
    p = {k: v.astype(np.float64) for k, v in
         gru.init_params(2, words=64, grams=64, d_word=3, d_char=3, hidden=4).items()}
    features = gru.token_features(["the", "idiot", "haus.", "x"], 64, 64)
    X, lengths, y = np.array([[0, 1, 2], [3, 1, 0], [2, 0, 0]]), np.array([3, 3, 1]), np.array([1.0, 0, 1])
    _, grad = gru.gradients(p, features, X, lengths, y)
    for k, g in grad.items():
        if isinstance(g, tuple):
            full = np.zeros_like(p[k])
            full[g[0]] = g[1]
            g = full
        i = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        sides = []
        for e in (1e-3, -1e-3):
            q = {a: b.copy() for a, b in p.items()}
            q[k][i] += e
            sides.append(gru.gradients(q, features, X, lengths, y)[0])
        assert g[i] == pytest.approx((sides[0] - sides[1]) / 2e-3, rel=2e-3, abs=1e-6)


def test_windows_overlap_and_reach_the_end():
    lengths = np.array([0, 1, 32, 33, 48, 49, 1000])
    text, first, size = windows(lengths)
    offsets = np.cumsum(lengths) - lengths
    for i, n in enumerate(lengths):
        spans = [(int(a - offsets[i]), int(a - offsets[i] + s)) for t, a, s in zip(text, first, size) if t == i]
        if not n:
            assert spans == []
            continue
        assert spans[0][0] == 0 and spans[-1][1] == n and all(b - a <= WINDOW for a, b in spans)
        assert all(b[0] - a[0] == STRIDE and b[0] < a[1] for a, b in zip(spans, spans[1:]))


def test_batched_windows_equal_single_ones():
    scorer = Scorer(gru.init_params(3, words=128, grams=128), table_words=10)
    texts = [[f"w{i * j % 17}" for j in range(n)] for i, n in enumerate((5, 40, 0, 100, 1))]
    together = scorer.text_logits(texts)
    for t, value in zip(texts, together):
        alone = Scorer(scorer.params).text_logits([t])[0]
        assert value == alone or value == pytest.approx(alone, abs=1e-4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").join(labels, "doc_id", "left_semi")
    out = toxicity(docs, labels, fold("doc_id", 3) == 1).filter("held_out").join(labels, "doc_id")
    toxic, caught, clean, wrong = out.agg(
        F.sum("toxic"), F.sum(F.col("toxic") * F.col("predicted")), F.sum(1 - F.col("toxic")),
        F.sum((1 - F.col("toxic")) * F.col("predicted"))).first()
    # 290 toxic texts to learn from; the sample bound is 800
    assert caught / toxic >= 0.85 and wrong / clean <= 0.03


def test_cases(spark, make_docs):
    rows = [(i, f"a nice day number {i} in town") for i in range(30)]
    rows += [(i, f"you idiot number {i} in town") for i in range(30, 60)]
    rows += [(70, None), (71, ""), (72, " \n"), (73, "a nice day number 3 in town " * 4000 + "you idiot number 40 in town"), (74, "!!!"), (74, "!!!"), (None, "x")]
    labels = spark.createDataFrame([(i, int(i >= 30)) for i in range(60)] + [(70, 1), (71, 0), (72, None), (None, 1)],
                                   "doc_id long, toxic int")
    out = toxicity(make_docs(rows, extra=True), labels, F.coalesce(F.col("doc_id") >= 70, F.lit(False))).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].score == 0 and by[i].predicted == 0 for i in (70, 71, 72))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert by[40].score > by[10].score and by[73].score > by[10].score
    assert toxicity(make_docs([]), labels, F.lit(False)).collect() == []
    assert {r.score for r in toxicity(make_docs(rows[:3]), labels.limit(0), F.lit(False)).collect()} == {0.0}


def _naive_logit(p, tokens):
    """One window by the textbook formulas, a position at a time; features by hand."""
    def embed(token):
        bare = token.strip(gru.PUNCT) or token
        word = p["word"][zlib.crc32(bare.encode()) % len(p["word"])]
        marked, grams = f"^{bare}$", []
        for a in range(len(marked)):
            for n in (3, 4, 5):
                if a + n <= len(marked):
                    code = 0
                    for k, c in enumerate(marked[a:a + n], 1):
                        code = (code * 0x9E3779B97F4A7C15 % 2**64) ^ (ord(c) + k)
                    grams.append(p["gram"][(code * 0xD6E8FEB86659FD93 % 2**64 >> 33) % len(p["gram"])])
        return np.concatenate((word, np.mean(grams, axis=0)))

    def states(vectors, W, U, b):
        k, out = U.shape[0], []
        h = np.zeros(k)
        for x in vectors:
            gx, gh = x @ W + b, h @ U
            z, r = (1 / (1 + np.exp(-(gx[i * k:(i + 1) * k] + gh[i * k:(i + 1) * k]))) for i in (0, 1))
            h = (1 - z) * np.tanh(gx[2 * k:] + r * gh[2 * k:]) + z * h
            out.append(h)
        return out

    xs = [embed(t) for t in tokens]
    both = [np.concatenate(s) for s in zip(states(xs, p["Wf"], p["Uf"], p["bf"]),
                                           states(xs[::-1], p["Wb"], p["Ub"], p["bb"])[::-1])]
    weight = np.exp([s @ p["att"] for s in both])
    return sum(w * s for w, s in zip(weight / weight.sum(), both)) @ p["out"] + p["bias"][0]


def test_scores_against_a_naive_network():
    p = gru.init_params(5, words=64, grams=128, d_word=3, d_char=4, hidden=5)
    rng = np.random.default_rng(5)
    p = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in p.items()}
    words = ["the", "idiot!", "haus.", "ab", "été", "?!", "x", "wonderful"]
    texts = [[words[i] for i in rng.integers(0, len(words), n)] for n in (1, 2, 31, 32, 33, 90, 0)]
    got = Scorer(p).text_logits(texts)
    for t, value in zip(texts, got):
        spans = [t[a:a + WINDOW] for a in range(0, max(1, len(t) - WINDOW + STRIDE), STRIDE)] if t else []
        want = max((_naive_logit(p, s) for s in spans), default=-np.inf)
        assert value == want or value == pytest.approx(want, abs=1e-4)


def test_sample_words_come_from_all_over():
    words = [str(i) for i in range(100_000)]
    some = spread(words, 320)
    assert len(some) == 320 and some[0] == "0" and some[-1] == "99999" and len(set(some)) == 320
    assert spread(words[:300], 320) == words[:300]


def test_long_toxic_texts_do_not_teach_their_clean_windows(spark, make_docs):
    rows = [(i, f"a nice day number {i} in town") for i in range(30)]
    rows += [(i, f"you idiot number {i} in town") for i in range(30, 60)]
    rows += [(i, "a nice day in town " * 1000 + "you idiot") for i in range(60, 90)]  # toxic, its first words clean
    labels = spark.createDataFrame([(i, int(i >= 30)) for i in range(90)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity(make_docs(rows), labels, F.lit(False)).collect()}
    assert max(out[i].score for i in range(30)) < 0.7 <= min(out[i].score for i in range(30, 60))
