"""Every registered query against its SQL, and the contract around them."""

import pytest

import __spark_entry__ as contract
from catalog import QUERIES, SQL
from tools.check_queries import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_register():
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())
    assert set(contract.queries()) - set(QUERIES) == set(contract.LLM_QUERIES)
    assert contract.oracle_sql() == {**SQL, **contract.LLM_SQL}


def test_entry(spark):
    assert contract.entry(spark).columns == ["doc_id", "text_ar", "text_api"]


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, duck, SQL[name]) == ""
