import pytest

from pasarlens.registry import all_queries
from tools.compare import compare, connect

# Every query with SQL, trainings included, is compared value by value.
CHECKED = [q for q in all_queries() if q.sql]


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("query", CHECKED, ids=[q.name for q in CHECKED])
def test_query_equals_sql(spark, db, folder, query):
    verdict, note = compare(spark, db, query, folder)
    assert verdict in ("ok", "ok?"), note


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
