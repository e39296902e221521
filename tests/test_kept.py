"""Rows that several steps read are worked out once and kept as column files; numbers do not depend on how keys are dealt out."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from freightmart.operators import joins, ordinal
from freightmart.plans import carriers, nomenclature
from freightmart.session import cut_lineage


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def written(spark, path, schema, rows):
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.parquet(str(path))


def reads(df, path):
    return any(str(path) in f for f in df.inputFiles())


def test_kept_rows_are_column_files_of_any_columns(spark):
    df = spark.sql("SELECT id, concat('a', id) AS `x.y`, id AS id, date'2020-01-01' AS d FROM range(5)")
    kept = cut_lineage(df)
    assert kept.columns == df.columns and rows_of(kept) == rows_of(df)
    assert all(f.endswith(".zstd.parquet") for f in kept.inputFiles()) and kept.inputFiles()
    odd = spark.sql("SELECT id, NULL AS nothing, make_dt_interval(id) AS span FROM range(3)")
    assert rows_of(cut_lineage(odd)) == rows_of(odd)


@pytest.mark.parametrize("where", [None, "v > 1"])
def test_hot_keys_are_numbered_like_others(spark, where):
    where = where and F.expr(where)
    rows = [(k, v, i % 3) for i, (k, v) in enumerate([(k, v) for k in (None, "a", "b") for v in (None, 1, 1, 2, 3)] * 2)]
    df = spark.createDataFrame(rows, "k string, v int, rest int")
    plain = rows_of(ordinal.number_rows(df, ["k"], ["v"], "n", where=where))
    old, ordinal.HOT = ordinal.HOT, 0
    try:
        assert rows_of(ordinal.number_rows(df, ["k"], ["v"], "n", where=where)) == plain
    finally:
        ordinal.HOT = old


def test_link_full_join_keeps_rows_without_key(spark):
    one = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, x string")
    many = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (3, 13)], "j int, y int")
    want = Counter([(1, "a", 1, 10), (1, "a", 1, 11), (1, "b", 1, 10), (1, "b", 1, 11), (None, "c", None, None),
                    (2, "d", None, None), (None, None, None, 12), (None, None, 3, 13)])
    assert rows_of(joins.link_full_join(one, many, [("k", "j")])) == want


def test_carrier_rating_reads_the_days_once(spark, tmp_path):
    from datetime import date

    names = ["requests", "won", "cancelled", "cancelled_by_carrier", "complex_routes", "mobile_application", "from_far_east", "own_transport"]
    days = written(spark, tmp_path / "days", "tax_id string, day date, transport_price decimal(18,2), " + ", ".join(f"{n} int" for n in names),
                   [("T1", date(2001, m, 2), Decimal(5), 1, 1, 0, 0, 0, 0, 0, 0) for m in (1, 2, 2)])
    listed = spark.sql("SELECT 'T1' AS tax_id, 'c' AS carrier_name, timestamp_ntz'2000-01-01' AS created_at")
    found = carriers.carrier_rating(listed, days, date(2001, 12, 1))
    assert not reads(found, tmp_path / "days")
    got = {r.month.month: (r.requests, r.first_win, r.last_win, r.requests_185, int(r.transport_price), int(r.transport_price_1y)) for r in found.collect()}
    first, last = date(2001, 1, 2), date(2001, 2, 2)
    assert got == {1: (1, first, last, 0, 5, 0), 2: (2, first, last, 1, 10, 5)}


def test_cargo_items_are_matched_once(spark, tmp_path):
    items = written(spark, tmp_path / "items", "cargo string, name string, article string, code string, quantity double, cost double",
                    [("c", "n", "a", "k", 2.0, 3.0)])
    dim = spark.createDataFrame([("k", "a", True), ("k", "b", None)], "code string, article string, is_line boolean")
    found = nomenclature.cargo_totals(items, dim)
    assert not reads(found, tmp_path / "items")
    assert rows_of(found) == Counter([("c", 4.0, 6.0, "1", "n; n", "a; a", "k; k")])
