"""Every registered query against SQL over the same tables."""

import pytest

import __spark_entry__ as entry_points
from compare import oracle_connection, oracle_result, spark_result

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    llm = {q for q in QUERIES if q.startswith("op") and q[2].isdigit()} | {"pipeline"}
    assert set(QUERIES) - set(ORACLE) <= llm


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    got = spark_result(QUERIES[name](spark, FOLDER))
    want = oracle_result(con, ORACLE[name])
    assert want[1], "the oracle finds nothing to compare"
    assert got == want


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["dt", "hr", "n"]
