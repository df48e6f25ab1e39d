from revmart.operators.quality import Rule, column_checks, scd2_checks, unique_check
from tests.conftest import ts


def test_column_rules(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), (None, "bad"), ("d", "bad"), ("e", "worse")],
                               "id string, status string")
    out = {(r.column_name, r.rule): (r.failures, r.failing_rows) for r in column_checks(
        df, "t", [Rule("id", "not_null"), Rule("status", "accepted_values", ("x",)),
                  Rule("status", "max_length", max_length=3)]).collect()}
    assert out[("id", "not_null")] == (1, 1)
    assert out[("status", "accepted_values")] == (2, 3)  # distinct bad values, bad rows; NULL passes
    assert out[("status", "max_length")] == (1, 1)


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "id string")
    r = unique_check(df, "t", ["id"]).first()
    assert (r.failures, r.failing_rows) == (1, 3)


def test_scd2_overlap_and_open_rows(spark):
    h = spark.createDataFrame([
        ("k1", ts("2025-01-01 00:00:00"), ts("2025-03-01 00:00:00")),
        ("k1", ts("2025-02-01 00:00:00"), None),          # overlaps the first
        ("k2", ts("2025-01-01 00:00:00"), None),
        ("k2", ts("2025-02-01 00:00:00"), None),          # two open rows
        ("k3", ts("2025-01-01 00:00:00"), ts("2025-02-01 00:00:00")),
        ("k3", ts("2025-02-01 00:00:00"), None),          # clean
    ], "k string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = {r.rule: (r.failures, r.failing_rows) for r in scd2_checks(h, "h", ["k"]).collect()}
    assert out["scd2_no_overlap"] == (2, 2)
    assert out["scd2_single_open_row"] == (1, 2)
