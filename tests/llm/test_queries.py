import pytest

from docweave.llm.queries import ORACLE, QUERIES
from tests.llm.test_dedup import brute_components
from tools.check import canonical, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = canonical(QUERIES[name](spark, SF_DIR).toPandas())
    want = canonical(duck.execute(ORACLE[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) > 0 and got.equals(want)


def test_near_copies_of_the_table_are_those_of_brute_force(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    ids = [doc_id for doc_id, _ in rows]
    want = dict(zip(ids, (ids[root] for root in brute_components([text for _, text in rows], 2))))
    assert {r.doc_id: r.component_id for r in QUERIES["op10_minhash_near_dedup"](spark, SF_DIR).collect()} == want
