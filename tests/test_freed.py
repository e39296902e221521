"""Steps that are kept leave no shuffle files, equal shuffles are made once, and kept steps can be removed."""

import re
import time
from collections import Counter
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from freightmart.catalog import money
from freightmart.operators import joins, ordinal, totals
from freightmart.plans import tracking
from freightmart.session import FREED, cut_lineage, forget
from freightmart.sources.tables import ParquetTables


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in folders for f in Path(d.toString()).rglob("shuffle_*")}


@pytest.fixture
def shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def ran(df):
    rows = Counter(tuple(r) for r in df.collect())
    return rows, df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]


@pytest.mark.parametrize("step", ["kept", "few", "numbered"])
def test_kept_steps_leave_no_shuffle_files(spark, step):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    there, setting = shuffle_files(spark), spark.conf.get(FREED)
    if step == "kept":
        cut_lineage(rows)
    elif step == "few":
        joins.few_rows(rows)
    else:
        ordinal.number_rows(rows, ["k"], ["count"], "n")
    until = time.time() + 20
    while shuffle_files(spark) - there and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - there
    assert spark.conf.get(FREED) == setting


def test_full_join_moves_the_documents_once(spark, shuffled):
    one = spark.createDataFrame([("1", "a"), (None, "b"), ("2", "c")], "k string, x string")
    many = spark.createDataFrame([("1", 5), ("3", 6), (None, 7)], "j string, y int")
    rows, plan = ran(joins.link_full_join(one, many, [("k", "j")]))
    assert rows == Counter([("1", "a", "1", 5), (None, "b", None, None), ("2", "c", None, None), (None, None, "3", 6), (None, None, None, 7)])
    assert "ReusedExchange" in plan


def test_forgotten_steps_are_removed_and_no_others(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    own = spark.read.parquet(str(tmp_path / "own"))
    first, second = cut_lineage(own), cut_lineage(own.select((F.col("id") + 1).alias("x")))
    joined = first.crossJoin(own.select(F.col("id").alias("other")))
    done = cut_lineage(joined)
    forget(joined)
    gone = [re.sub("^file:/*", "/", f) for f in first.inputFiles()]
    assert gone and not any(Path(f).exists() for f in gone)
    assert done.count() == 9 and second.count() == 3 and own.count() == 3


def test_legs_are_ranked_and_joined_in_place(spark, shuffled):
    at = lambda d: datetime(2011, 5, d)
    rows = spark.createDataFrame(
        [("A", at(1), "p", "w1"), ("A", at(2), "p", "w2"), ("A", at(3), None, "w3"), ("", at(1), "p", "w4"), (None, at(4), "p", "w5"), (None, at(5), "q", "w6")],
        "request_number string, plan_loading timestamp_ntz, load_address string, consolidation_warehouse string")
    none = F.lit(None).cast("timestamp_ntz")
    rows = rows.withColumns({
        "fact_loading": F.col("plan_loading"), "plan_unloading": none, "fact_unloading": none, "route_date": none, "route": F.lit("r"),
        "guid": F.lit("g"), "final_status": F.lit("s"), "platform_status": F.lit("s")})
    found, plan = ran(tracking.latest_leg(rows).select(
        "request_number", "consolidation_warehouse", "prev_warehouse", "points", F.dayofmonth("first_plan_loading")))
    assert found == Counter([("A", "w3", "w2", 2, 1), ("", "w4", None, 1, 1), (None, "w6", "w5", 2, 4)])
    assert plan.count("Exchange hashpartitioning") == 4


@pytest.mark.parametrize(("more", "hot"), [([], False), (["a"], True)])
def test_keys_of_one_hash_are_counted_one_by_one(spark, monkeypatch, more, hot):
    monkeypatch.setattr(ordinal, "HOT", 1)
    monkeypatch.setattr(ordinal, "BUCKETS", 1)
    rows = spark.createDataFrame([(k,) for k in [None, "a", "b", *more]], "k string")
    assert ordinal.has_hot_key(rows, ["k"]) is hot


def test_many_totals_move_whole_rows_once(spark, shuffled):
    rows = spark.createDataFrame([("a", None, 1, "p"), ("a", "x", 2, "q"), (None, "x", 3, "r"), (None, "x", 3, "r")], "k string, j string, v int, wide string")
    found, plan = ran(totals.attach_many_totals(rows, [
        (["k"], {"by_k": F.sum("v")}), (["j"], {"by_j": F.sum("v")}), (["k", "j"], {"by_both": F.count(F.lit(1))})]))
    assert found == Counter([("a", None, 1, "p", 3, 1, 1), ("a", "x", 2, "q", 3, 8, 1), (None, "x", 3, "r", 6, 8, 2), (None, "x", 3, "r", 6, 8, 2)])
    assert plan.count("Exchange hashpartitioning") == 2


def test_requests_are_grouped_where_their_lines_were_joined(spark, shuffled, tmp_path):
    t = SimpleNamespace(
        orders=spark.sql("SELECT 1L AS o_orderkey, 2L AS o_custkey, 'F' AS o_orderstatus, timestamp_ntz'1997-01-01' AS o_orderdate, '1-URGENT' AS o_orderpriority"),
        customer=spark.sql("SELECT 2L AS c_custkey, 'c' AS c_name, 'm' AS c_mktsegment"), part=spark.sql("SELECT 3L AS p_partkey, 't' AS p_type"),
        lineitem=spark.sql(
            "SELECT key AS l_orderkey, 3L AS l_partkey, 4L AS l_suppkey, n AS l_linenumber, 5.0D AS l_quantity, 6.0D AS l_extendedprice, 0.02D AS l_discount, "
            "0.03D AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus, timestamp_ntz'1997-02-01' AS l_shipdate FROM VALUES (1L, 1), (1L, 2), (NULL, 3), (9L, 1) v(key, n)"))
    for name, rows in vars(t).items():
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    t = ParquetTables(spark, str(tmp_path))
    found, plan = ran(money.route_rows(t).groupBy("request_number").agg(F.count("route_number"), F.max("class1")))
    assert found == Counter([("1", 2, 2)])
    assert len(re.findall(r"Exchange hashpartitioning\(request_number#\d+, ", plan)) == 2


def test_repeated_look_ups_of_a_request_repeat_its_routes(spark):
    clock = tracking.Clock(datetime(2011, 12, 1))
    one = lambda sql: spark.sql(f"SELECT {sql}")
    at = "timestamp_ntz'2011-10-01'"
    requests = one(
        f"'q' AS ref, 'Q' AS number, {at} AS created_at, 'la' AS load_address, 'ua' AS unload_address, 's' AS sender, 'none' AS recipient, 's' AS payer, "
        "CAST(2 AS decimal(10,3)) AS weight, CAST(1 AS decimal(10,3)) AS width, CAST(1 AS decimal(10,3)) AS height, CAST(1 AS decimal(10,3)) AS depth, 8.0D AS price, "
        "'x' AS created_in, 1.0D AS volume, true AS trawl, true AS fourpl, 'k' AS delivery_kind, false AS deleted, true AS posted")
    routes = spark.sql(
        f"SELECT 'q' AS request, concat('N', n) AS number, concat('G', n) AS route, 'p' AS price_type, {at} AS route_date, {at} AS plan_loading, {at} AS fact_loading, "
        f"{at} AS plan_unloading, {at} AS fact_unloading, 'st' AS status, n AS line, 'w' AS warehouse, true AS on_warehouse, 'car' AS carrier, 'd' AS driver, 1.0D AS carrier_price, "
        "1.0D AS customer_price, 1 AS position, 'a' AS load_address, 'b' AS unload_address, '+' AS driver_phone, 1.0D AS distance, 'k' AS delivery_kind, 'k' AS route_kind, "
        "'k' AS trailer_kind FROM VALUES (1), (2) v(n)")
    companies = spark.createDataFrame([("s", "S1", "t", "k"), ("s", "S2", "t", "k"), ("car", "C", "t", "k")], "ref string, name string, tax_id string, kpp string")
    found = tracking.dispatch_requests(
        requests, routes, one("'st' AS ref, 'fine' AS name"), one(f"'q' AS request, 'st' AS status, {at} AS period"), companies,
        one("'la' AS address, 'city' AS city, 'r' AS region, 'RU' AS country"), one(f"'q' AS request, {at} AS issued_at, false AS deleted"),
        one("'k' AS ref, 'kind' AS name"), clock)
    got = Counter((r.route, r.sender, r.payer, r.recipient, r.carrier, r.status, r.sender_city, r.recipient_city, r.power_of_attorney, float(r.part_in_route))
                  for r in found.collect())
    assert got == Counter((f"N{n}", s, p, None, "C", "fine", "city", None, 1, 0.25) for n in (1, 2) for s in ("S1", "S2") for p in ("S1", "S2"))
    assert all("/kept-" in f for f in found.inputFiles())
