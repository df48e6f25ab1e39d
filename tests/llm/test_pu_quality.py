from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from revmart.llm.common import fold, table
from revmart.llm.pu_quality import estimate_prior, fit, pu_slopes, quality, text_features


def test_slopes_are_the_risk_gradient():
    rng = np.random.default_rng(0)
    zp, zu = rng.standard_normal(5), rng.standard_normal(7)
    sp, su, risk = pu_slopes(zp, zu, 0.4)
    for i in range(5):
        z = zp.copy()
        z[i] += 1e-5
        assert (pu_slopes(z, zu, 0.4)[2] - risk) / 1e-5 == pytest.approx(sp[i], abs=1e-4)
    for i in range(7):
        z = zu.copy()
        z[i] += 1e-5
        assert (pu_slopes(zp, z, 0.4)[2] - risk) / 1e-5 == pytest.approx(su[i], abs=1e-4)


def test_negative_part_never_pays_off():
    zp, zu = np.full(4, 3.0), np.full(4, -3.0)  # unlabelled risk below prior * positives': overfitted
    _, su, risk = pu_slopes(zp, zu, 0.9)
    assert risk == pytest.approx(0.9 * np.logaddexp(0, -zp).mean()) and (su < 0).all()


def test_prior_and_separation_on_a_known_mixture():
    rng = np.random.default_rng(1)
    d = len(text_features("x"))
    good, bad = lambda n: rng.standard_normal((n, d)), lambda n: rng.standard_normal((n, d)) + 1.0
    network, prior = fit(good(1500), np.concatenate((good(2100), bad(900))))
    assert prior == pytest.approx(0.7, abs=0.08)
    assert (network.logits(good(500)) > 0).mean() > 0.95 and (network.logits(bad(500)) < 0).mean() > 0.95
    same = rng.standard_normal(2000)
    assert estimate_prior(same, same.copy()) > 0.9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    out = (quality(table(spark, sf, "documents"), labels, fold("doc_id", 5) == 0)
           .filter("held_out").join(labels, "doc_id"))
    good, kept, bad, dropped = out.agg(
        F.sum("quality"), F.sum(F.col("quality") * F.col("predicted")), F.sum(1 - F.col("quality")),
        F.sum((1 - F.col("quality")) * (1 - F.col("predicted")))).first()
    assert kept / good >= 0.97 and dropped / bad >= 0.85


def test_cases(spark, make_docs):
    rows = [(i, f"A quiet line of prose, number {i}. Then another one.") for i in range(40)]
    rows += [(i, "BUY!! NOW!! " * 5) for i in range(40, 50)]
    rows += [(60, None), (61, ""), (62, "\n \n"), (63, "word " * 50_000), (63, "x"), (63, "x"), (None, "y")]
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(60, 1), (None, 1), (41, None), (42, 0)],
                                   "doc_id long, quality int")
    out = quality(make_docs(rows, extra=True), labels, F.col("doc_id") == 63).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[60] == by[61]
    assert quality(make_docs([]), labels, F.lit(False)).collect() == []
    assert {r.score for r in quality(make_docs(rows[:3]), labels.limit(0), F.lit(False)).collect()} == {0.0}
