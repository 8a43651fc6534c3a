"""Every query against its SQL; queries without SQL must run and give rows."""

import pytest
from oracle import connect, difference

from linkloom.plans import audits, decisions, evidence, records  # noqa: F401
from linkloom.plans.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, data, con, name):
    assert difference(QUERIES[name](spark, data), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["s1_id", "cand_id", "rank"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
