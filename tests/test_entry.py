"""The driver contract: every query runs on the smallest tables, and SQL agrees where there is one."""

import os

import pytest

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def _registered():
    from marlstone.plans import control_queries, data_queries, dataset_queries, market_queries

    parts = (market_queries, control_queries, dataset_queries, data_queries)
    return {k: v for p in parts for k, v in p.QUERIES.items()}, {k: v for p in parts for k, v in p.ORACLE.items()}


@pytest.mark.parametrize("name", sorted(_registered()[0]))
def test_query_agrees_with_sql(spark, name):
    from compare import compare

    queries, oracle = _registered()
    if name in oracle:
        assert compare(spark, FOLDER, name, queries[name], oracle[name]) == ""
    else:
        assert queries[name](spark, FOLDER).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
