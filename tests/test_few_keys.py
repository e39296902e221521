"""Rows are not dealt out by a key of few values: a task would read all rows of one."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from freightmart.operators import joins
from freightmart.operators.totals import attach_totals
from freightmart.plans import waybills


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def no_own_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [10, 1])
def test_totals_of_few_groups_are_broadcast(spark, no_own_broadcast, monkeypatch, most):
    monkeypatch.setattr(joins, "FEW", most)
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 4)], "flag string, v int")
    found = attach_totals(rows, ["flag"], {"total": F.sum("v")}, few=True)
    assert ("broadcast" in plan(found)) == (most == 10)
    assert Counter(tuple(r) for r in found.collect()) == Counter([(None, 1, 3), (None, 2, 3), ("a", 3, 3), ("b", 4, 8), ("b", 4, 8)])


def test_documents_are_not_dealt_out_by_status(spark, no_own_broadcast):
    register = spark.sql("SELECT * FROM VALUES ('d1', 'R', 1), ('d1', 'A', 2), ('d2', 'R', 1), ('d2', 'R', 1), ('d3', NULL, 1) t(document, status, period)")
    names = spark.createDataFrame([("R", "released"), (None, "never")], "ref string, name string")
    found = waybills.latest_status(register, names, "x")
    assert "broadcast" in plan(found)
    assert sorted((r.document, r.x) for r in found.collect()) == [("d1", None), ("d2", "released"), ("d3", None)]
    named = waybills.latest_status(register, names, "x", must_have_name=True)
    assert sorted((r.document, r.x) for r in named.collect()) == [("d1", "released"), ("d2", "released")]
