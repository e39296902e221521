"""The tracking reports hold every request of the tables, the oldest too."""

from datetime import datetime

import pytest

from freightmart.catalog import QUERIES

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "AFRICA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "ALGERIA", 0)]),
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "c", 1, 5.0, "BUILDING")]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 1, 5.0)]),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(1, "p", "b", "PROMO", 9, 2.0)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        [(k, 1, "F", 9.0, datetime(*day), "3-MEDIUM") for k, day in ((1, (1995, 1, 27)), (2, (1998, 1, 27)))]),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        [(k, 1, 1, 1, 3.0, 7.0, 0.01, 0.05, "A", "F", datetime(*day)) for k, day in ((1, (1995, 2, 3)), (2, (1998, 2, 3)))]),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("old")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["platform_requests", "location_ladder", "dwell_days", "tracked_requests", "tracked_request_items"])
def test_oldest_request_is_reported(spark, folder, name):
    found = {r.request_number for r in QUERIES[name](spark, folder).collect()}
    assert found == {"BUI1", "BUI2"}
