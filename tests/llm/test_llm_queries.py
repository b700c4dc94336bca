"""The registered queries against their SQL and contracts."""

import zlib

import pytest

from tarjuman.llm.queries import QUERIES, SQL
from tools.check_queries import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) == ""


@pytest.mark.parametrize("name, divisor, remainder", [("op1_language_id", 4, 2), ("op9_toxicity", 3, 1)])
def test_held_out_rows(spark, name, divisor, remainder):
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % divisor == remainder)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
