import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import canonical, connect
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(ORACLE) == set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = canonical(QUERIES[name](spark, SF_DIR).toPandas())
    want = canonical(duck.execute(ORACLE[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) > 0 and got.equals(want)


def test_entry(spark):
    assert entry(spark).count() > 0
