"""Every registered query against its SQL."""

import pytest

import oracle
from weirgate.plans.registry import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def connection(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, connection, name):
    query = QUERIES[name]
    frame = query.run(spark, folder)
    if query.sql is None:
        assert frame.columns and len(frame.collect()) > 0
        return
    problem = oracle.differences(frame, connection, query.sql)
    assert problem is None, problem


def test_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    rows = contract.entry(spark).collect()
    assert 0 < len(rows) <= 25
