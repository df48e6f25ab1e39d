"""Registered queries against their DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from revmart.queries import QUERIES
from tools.check_oracle import canon, duck
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert canon(df.columns, s_rows) == canon(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["report_date", "client_id", "provider_id"]
    assert df.count() > 0
