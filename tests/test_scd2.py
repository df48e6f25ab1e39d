import random
from decimal import Decimal

import pytest

from revmart.functions.columns import ts_lit
from revmart.operators.scd2 import history_from_snapshots, scd2_step
from tests.conftest import ts

HIST = "k string, rate decimal(5,4), kind string, valid_from timestamp_ntz, valid_to timestamp_ntz"
SNAP = "k string, rate decimal(5,4), kind string"
R0, R1 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"


def _rows(df):
    return sorted(((r.k, r.rate, r.kind, r.valid_from, r.valid_to) for r in df.collect()), key=repr)


def test_step_rules(spark):
    D = Decimal
    history = spark.createDataFrame([
        ("same", D("0.1000"), "a", ts(R0), None),
        ("moved", D("0.1000"), "a", ts(R0), None),
        ("null_to_value", None, "a", ts(R0), None),
        ("value_to_null", D("0.1000"), "a", ts(R0), None),
        ("missing", D("0.1000"), "a", ts(R0), None),
        ("closed", D("0.0500"), "a", ts("2024-01-01 00:00:00"), ts(R0)),
    ], HIST)
    incoming = spark.createDataFrame([
        ("same", D("0.1000"), "a"), ("moved", D("0.2000"), "a"), ("null_to_value", D("0.3000"), "a"),
        ("value_to_null", None, "a"), ("new", D("0.4000"), "a"),
    ], SNAP)
    out = _rows(scd2_step(history, incoming, ["k"], ["rate", "kind"], ts_lit(R1)))
    assert out == sorted([
        ("same", D("0.1000"), "a", ts(R0), None),
        ("moved", D("0.1000"), "a", ts(R0), ts(R1)),
        ("moved", D("0.2000"), "a", ts(R1), None),
        ("null_to_value", None, "a", ts(R0), ts(R1)),
        ("null_to_value", D("0.3000"), "a", ts(R1), None),
        ("value_to_null", D("0.1000"), "a", ts(R0), ts(R1)),
        ("value_to_null", None, "a", ts(R1), None),
        ("missing", D("0.1000"), "a", ts(R0), None),
        ("closed", D("0.0500"), "a", ts("2024-01-01 00:00:00"), ts(R0)),
        ("new", D("0.4000"), "a", ts(R1), None),
    ], key=repr)


def test_empty_input_changes_nothing(spark):
    history = spark.createDataFrame([("a", Decimal("0.1000"), "x", ts(R0), None)], HIST)
    out = scd2_step(history, spark.createDataFrame([], SNAP), ["k"], ["rate", "kind"], ts_lit(R1))
    assert _rows(out) == _rows(history)


def test_duplicate_incoming_key_fails(spark):
    history = spark.createDataFrame([], HIST)
    incoming = spark.createDataFrame([("a", Decimal("0.1000"), "x"), ("a", Decimal("0.2000"), "x")],
                                     SNAP)
    with pytest.raises(Exception, match="not unique"):
        scd2_step(history, incoming, ["k"], ["rate", "kind"], ts_lit(R1)).collect()


def test_replay_equals_set_based(spark):
    """Property: replaying steps == history built from all snapshots at once."""
    rng = random.Random(7)
    runs = [f"2025-{m:02d}-01 00:00:00" for m in range(1, 9)]
    snaps = []
    for run in runs:
        for key in range(12):
            if rng.random() < 0.25:  # key absent from this snapshot (and maybe back later)
                continue
            rate = rng.choice([None, Decimal("0.1000"), Decimal("0.2000"), Decimal("0.3000")])
            snaps.append((f"k{key}", rate, rng.choice(["a", "b"]), ts(run)))
    all_snaps = spark.createDataFrame(snaps, SNAP + ", run_ts timestamp_ntz")
    history = spark.createDataFrame([], HIST)
    for run in runs:
        incoming = all_snaps.where(all_snaps.run_ts == ts_lit(run)).drop("run_ts")
        history = scd2_step(history, incoming, ["k"], ["rate", "kind"], ts_lit(run))
        history = spark.createDataFrame(history.collect(), HIST)  # keep plans small
    expected = history_from_snapshots(all_snaps, ["k"], ["rate", "kind"])
    assert _rows(history) == _rows(expected)
