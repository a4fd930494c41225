import pytest

from __spark_entry__ import entry, queries
from catalogue import QUERIES, SQL
from conftest import SMALL
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()
    assert queries().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, SMALL, name) == []


def test_entry(spark):
    report = entry(spark).orderBy("chunk_number").collect()
    assert [r.rows for r in report] == [400, 400, 400, 300]
    assert report[-1].percent == 100.0
