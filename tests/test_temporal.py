import pytest

from revmart.operators.temporal import interval_lookup
from tests.conftest import D, ts

HIST = ("provider_id string, biller_id string, commission_rate decimal(5,4), "
        "valid_from timestamp_ntz, valid_to timestamp_ntz")
FACTS = "id string, provider_id string, company_code string, transaction_timestamp timestamp_ntz"


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame([
        ("P1", "B1", D("0.0500"), ts("2025-01-01 00:00:00"), ts("2025-06-01 00:00:00")),
        ("P1", "B1", D("0.0480"), ts("2025-06-01 00:00:00"), None),
        # covering row with a NULL rate falls through to the current rate
        ("P2", "B1", None, ts("2025-01-01 00:00:00"), ts("2025-06-01 00:00:00")),
        ("P2", "B1", D("0.0300"), ts("2025-06-01 00:00:00"), None),
        # no open row: no fallback
        ("P3", "B1", D("0.0200"), ts("2025-01-01 00:00:00"), ts("2025-02-01 00:00:00")),
    ], HIST)


CASES = [
    ("inside", "P1", "B1", "2025-03-01 00:00:00", "0.0500"),
    ("at_valid_from", "P1", "B1", "2025-06-01 00:00:00", "0.0480"),
    ("just_before_valid_to", "P1", "B1", "2025-05-31 23:59:59", "0.0500"),
    ("before_first_version", "P1", "B1", "2024-03-01 00:00:00", "0.0480"),
    ("unknown_key", "P9", "B1", "2025-03-01 00:00:00", None),
    ("null_rate_cover", "P2", "B1", "2025-03-01 00:00:00", "0.0300"),
    ("closed_only_inside", "P3", "B1", "2025-01-15 00:00:00", "0.0200"),
    ("closed_only_after", "P3", "B1", "2025-03-01 00:00:00", None),
]


@pytest.mark.parametrize("options", [{}, {"broadcast": True}, {"salt_buckets": 3}])
def test_interval_cases(spark, history, options):
    facts = spark.createDataFrame([(c[0], c[1], c[2], ts(c[3])) for c in CASES], FACTS)
    out = interval_lookup(facts, history, {"provider_id": "provider_id", "company_code": "biller_id"},
                          "transaction_timestamp", {"commission_rate": "commission_rate"},
                          **options)
    got = {r.id: r.commission_rate for r in out.collect()}
    assert got == {c[0]: (D(c[4]) if c[4] else None) for c in CASES}
    assert out.columns == facts.columns + ["commission_rate"]


def test_overlap_picks_latest_valid_from(spark):
    hist = spark.createDataFrame([
        ("P1", "B1", D("0.0100"), ts("2025-01-01 00:00:00"), None),
        ("P1", "B1", D("0.0200"), ts("2025-02-01 00:00:00"), None),
    ], HIST)
    facts = spark.createDataFrame([("a", "P1", "B1", ts("2025-03-01 00:00:00"))], FACTS)
    for options in ({}, {"broadcast": True}, {"salt_buckets": 3}):
        out = interval_lookup(facts, hist, {"provider_id": "provider_id", "company_code": "biller_id"},
                              "transaction_timestamp", {"commission_rate": "commission_rate"}, **options)
        assert [r.commission_rate for r in out.collect()] == [D("0.0200")]


def test_plan_has_no_nested_loop_or_python(spark, history):
    facts = spark.createDataFrame([(c[0], c[1], c[2], ts(c[3])) for c in CASES], FACTS)
    out = interval_lookup(facts, history, {"provider_id": "provider_id", "company_code": "biller_id"},
                          "transaction_timestamp", {"commission_rate": "commission_rate"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "Python" not in plan


def test_lookup_leaves_nothing_cached(spark, history):
    spark.catalog.clearCache()
    facts = spark.createDataFrame([(c[0], c[1], c[2], ts(c[3])) for c in CASES], FACTS)
    interval_lookup(facts, history, {"provider_id": "provider_id", "company_code": "biller_id"},
                    "transaction_timestamp", {"commission_rate": "commission_rate"}).collect()
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_large_history_is_shuffled(spark, history):
    facts = spark.createDataFrame([(c[0], c[1], c[2], ts(c[3])) for c in CASES], FACTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = interval_lookup(facts, history, {"provider_id": "provider_id",
                                               "company_code": "biller_id"},
                              "transaction_timestamp", {"commission_rate": "commission_rate"})
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert {r.id: r.commission_rate for r in out.collect()}["inside"] == D("0.0500")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_salted_shuffle_path_matches(spark, history):
    facts = spark.createDataFrame([(c[0], c[1], c[2], ts(c[3])) for c in CASES], FACTS)
    on = {"provider_id": "provider_id", "company_code": "biller_id"}
    plain = interval_lookup(facts, history, on, "transaction_timestamp",
                            {"commission_rate": "commission_rate"}, broadcast=True)
    salted = interval_lookup(facts, history, on, "transaction_timestamp",
                             {"commission_rate": "commission_rate"}, salt_buckets=4)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
