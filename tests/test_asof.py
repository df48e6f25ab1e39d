"""The as-of merge gives the rows of the array lookup, however its hot keys are split."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from revmart.operators.asof import asof_lookup
from revmart.operators.temporal import interval_lookup

ON, VALUES = {"k": "a", "j": "b"}, {"v": "rate"}
HISTORY = "a int, b int, v int, valid_from timestamp_ntz, valid_to timestamp_ntz"


def _day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def tables(spark):
    """Gaps, NULL values, keys without an open version, unknown and NULL keys, NULL times, one key with most rows."""
    rng = random.Random(1)
    history = []
    for k in range(12):
        t = rng.randint(0, 30)
        for _ in range(rng.randint(0, 8)):
            end = t + rng.randint(1, 20)
            history.append((k, k % 3, rng.choice([None, rng.randint(1, 99)]), _day(t), _day(end)))
            t = end + rng.choice([0, 0, 3])
        if rng.random() < 0.7:
            history.append((k, k % 3, rng.choice([None, 5, rng.randint(1, 99)]), _day(t), None))
    facts = []
    for i in range(1500):
        k = rng.choice([1, 1, 1, 1, *range(2, 12), 50, None])
        j = k % 3 if k is not None and rng.random() < 0.98 else None
        facts.append((i, k, j, rng.choice([None, *(_day(rng.randint(-5, 150)) for _ in range(15))])))
    return (spark.createDataFrame(facts, "id int, k int, j int, t timestamp_ntz"),
            spark.createDataFrame(history, HISTORY))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("hot_rows, hot_share, splits", [(10**9, 0.1, 4), (100, 0.1, 7), (0, 0.0, 3), (1, 0.0, 60)])
def test_equals_the_array_lookup(tables, hot_rows, hot_share, splits):
    facts, history = tables
    got = asof_lookup(facts, history, ON, "t", VALUES, hot_rows=hot_rows, hot_share=hot_share, splits=splits)
    want = interval_lookup(facts, history, ON, "t", VALUES)
    assert got.columns == want.columns and _rows(got) == _rows(want)


def test_a_hot_key_is_sorted_in_several_groups(tables):
    facts, history = tables
    from revmart.operators.asof import hot_bounds
    bounds = hot_bounds(facts.where("k is not null and j is not null"), ["k", "j"], "t", 100, 0.1, 5).collect()
    assert [(r["k"], r["j"]) for r in bounds] == [(1, 1)] and 2 <= len(bounds[0]["__bounds"]) <= 4


def test_facts_are_exchanged_once_and_histories_not_broadcast(tables):
    facts, history = tables
    # several inputs each, as a join would need: the plan holds what is moved
    plan = asof_lookup(facts, history, ON, "t", VALUES)._jdf.queryExecution().executedPlan().toString()
    main = plan[:plan.index("BroadcastExchange")]
    assert main.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_overlapping_versions_fail_the_job(spark, tables):
    facts, history = tables
    twice = history.union(spark.createDataFrame([(1, 1, 3, _day(0), None)], HISTORY))
    with pytest.raises(Exception, match="overlapping versions"):
        asof_lookup(facts, twice, ON, "t", VALUES).collect()


def test_empty_sides(spark, tables):
    facts, history = tables
    assert asof_lookup(facts.limit(0), history, ON, "t", VALUES).count() == 0
    assert {r["rate"] for r in asof_lookup(facts, history.limit(0), ON, "t", VALUES).collect()} == {None}


def test_two_lookups_read_each_history_once(spark, tmp_path):
    """Counting hot keys and facts without a key are no further evaluation of the lookup before."""
    from revmart.operators.asof import asof_lookup as lookup
    spark.createDataFrame([(1, 1, 7, _day(0), None)], HISTORY).write.parquet(f"{tmp_path}/rates")
    spark.createDataFrame([(1, 1, 8, _day(0), None)], HISTORY).write.parquet(f"{tmp_path}/shares")
    spark.createDataFrame([(1, 1, 1, _day(1)), (2, None, 1, _day(1)), (3, 2, 2, _day(1))],
                          "id int, k int, j int, t timestamp_ntz").write.parquet(f"{tmp_path}/facts")
    facts, rates, shares = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("facts", "rates", "shares"))
    first = lookup(facts, rates, ON, "t", {"v": "rate"})
    both = lookup(first, shares, ON, "t", {"v": "share"}, times=facts)
    assert _rows(both.select("id", "rate", "share")) == [(1, 7, 8), (2, None, None), (3, None, None)]
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and plan.count("valid_from") and "__open" not in plan


def test_each_version_is_one_event(spark):
    """An open version leads its key's rows by the window, not as a second row."""
    history = spark.createDataFrame([(1, 1, 7, _day(0), _day(3)), (1, 1, 9, _day(3), None)], HISTORY)
    facts = spark.createDataFrame([(1, 1, 1, _day(-9)), (2, 1, 1, None), (3, 1, 1, _day(1))],
                                  "id int, k int, j int, t timestamp_ntz")
    out = asof_lookup(facts, history, ON, "t", VALUES)
    assert _rows(out.select("id", "rate")) == [(1, 9), (2, 9), (3, 7)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    union = plan[plan.index("Union"):]
    assert union.count("Generate explode") == 1
