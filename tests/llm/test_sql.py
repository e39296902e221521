"""Queries that SQL can express equal their SQL on the smallest tables, and all are registered."""

from pathlib import Path

import pytest

from freightmart.llm.queries import QUERIES, SQL

from ..oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(llm, name):
    pytest.importorskip("duckdb")

    class Bound:
        sql = SQL[name]

        def __call__(self, spark, folder):
            return QUERIES[name](spark, folder)

    assert compare(llm, connect(FOLDER), Bound(), FOLDER) is None


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
