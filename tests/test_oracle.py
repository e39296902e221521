"""Every registered query equals its SQL on the small test tables."""

from pathlib import Path

import pytest

from freightmart.catalog import QUERIES

from .oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert QUERIES[name].sql is not None
    assert compare(spark, con, QUERIES[name], FOLDER) is None
