"""First rows, ties, ordinals, texts and totals per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import semantics as s
from ..operators.ordinal import number_rows, pair_by_ordinal
from ..operators.stringagg import list_parts, list_values
from ..operators.topk import first_per_key, first_with_ties
from ..operators.totals import attach_totals
from .registry import money, query, text


@query("""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
  FROM events) WHERE rn = 1
""")
def latest_per_key(t):
    newest = first_per_key(t.events, ["user_id"], [s.descending("ts"), s.descending("event_id")])
    return newest.select("user_id", "event_id", "event_type", "value")


@query("""
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity FROM (
  SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC NULLS FIRST) AS r FROM lineitem) WHERE r = 1
""")
def rank_ties(t):
    best = first_with_ties(t.lineitem, ["l_partkey"], [s.descending("l_quantity")])
    return best.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


@query("""
WITH r AS (SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, row_number() OVER (
             PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_suppkey) AS n
           FROM lineitem WHERE l_returnflag = 'R'),
     a AS (SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, row_number() OVER (
             PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_suppkey) AS n
           FROM lineitem WHERE l_returnflag = 'A')
SELECT r.l_partkey, r.n AS ordinal, r.l_orderkey AS r_order, r.l_quantity AS r_quantity,
       a.l_orderkey AS a_order, a.l_quantity AS a_quantity
FROM r LEFT JOIN a ON a.l_partkey = r.l_partkey AND a.n = r.n
""")
def ordinal_pairing(t):
    def side(flag: str, prefix: str):
        order = ["shipped", "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey"]
        rows = t.lineitem.where(F.col("l_returnflag") == flag).select(
            "l_partkey", F.col("l_shipdate").alias("shipped"), "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
        return rows.select("l_partkey", *[F.col(c).alias(f"{prefix}_{c}") for c in order]), [f"{prefix}_{c}" for c in order]

    left, left_order = side("R", "r")
    right, right_order = side("A", "a")
    paired = pair_by_ordinal(left, right, ["l_partkey"], left_order, right_order)
    return paired.select(
        "l_partkey", "ordinal", F.col("r_l_orderkey").alias("r_order"), F.col("r_l_quantity").alias("r_quantity"),
        F.col("a_l_orderkey").alias("a_order"), F.col("a_l_quantity").alias("a_quantity"),
    )


@query("""
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey, row_number() OVER (
         PARTITION BY l_suppkey, flag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity) AS position
FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag FROM lineitem)
""")
def row_ordinals(t):
    rows = t.lineitem.select(
        "l_suppkey", "l_returnflag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    numbered = number_rows(
        rows, ["l_suppkey", "flag"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], "position")
    return numbered.select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "position")


@query("""
SELECT o_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def listagg_distinct(t):
    rows = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return list_values(rows, ["o_orderkey"], "l_returnflag", ",", "flags")


@query("""
SELECT l_orderkey, string_agg(flag, '; ' ORDER BY flag) AS flags
FROM (SELECT l_orderkey, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag FROM lineitem) GROUP BY l_orderkey
""")
def listagg_all(t):
    rows = t.lineitem.select("l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"))
    return list_values(rows, ["l_orderkey"], "flag", "; ", "flags", distinct=False)


@query("""
SELECT l_returnflag, part, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT l_returnflag, item, (row_number() OVER (PARTITION BY l_returnflag ORDER BY item) - 1) // 1000 AS part FROM (
    SELECT l_returnflag, CASE WHEN l_linenumber > 1 THEN l_partkey::VARCHAR END AS item FROM lineitem) WHERE item IS NOT NULL)
GROUP BY l_returnflag, part
""")
def listagg_parts(t):
    """Three groups of a third of all lines each, in parts of 1,000 values."""
    rows = t.lineitem.select("l_returnflag", F.when(F.col("l_linenumber") > 1, text("l_partkey")).alias("item"))
    return list_parts(rows, ["l_returnflag"], "item", ",", "items", distinct=False, size=1000)


@query("""
SELECT user_id, max(n) AS events, max(first_type) AS first_type, max(last_type) AS last_type, max(last_dated) AS last_dated
FROM (SELECT user_id, count(*) OVER (PARTITION BY user_id) AS n,
             first_value(event_type) OVER (PARTITION BY user_id ORDER BY stamp ASC NULLS LAST, event_id) AS first_type,
             first_value(event_type) OVER (PARTITION BY user_id ORDER BY stamp DESC NULLS FIRST, event_id DESC) AS last_type,
             first_value(event_id) OVER (PARTITION BY user_id ORDER BY stamp DESC NULLS LAST, event_id DESC) AS last_dated
      FROM (SELECT *, CASE WHEN event_type <> 'error' THEN ts END AS stamp FROM events))
GROUP BY user_id
""")
def first_last_by_date(t):
    rows = t.events.withColumn("at", F.when(F.col("event_type") != "error", F.col("ts")))
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), s.earliest("event_type", "at", "event_id").alias("first_type"),
        s.latest("event_type", "at", "event_id").alias("last_type"),
        s.latest("event_id", "at", "event_id", nulls_win=False).alias("last_dated"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round((q / sum(q) OVER (PARTITION BY l_orderkey))::DOUBLE, 6) AS share,
       count(*) OVER (PARTITION BY l_orderkey) AS lines,
       sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey)::BIGINT AS returned,
       max(l_shipdate)  OVER (PARTITION BY l_orderkey)::DATE::VARCHAR AS last_shipped,
       (sum(l_extendedprice::DECIMAL(18,2)) OVER (PARTITION BY flag))::DOUBLE AS flag_total
FROM (SELECT *, l_quantity AS q, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS flag FROM lineitem)
""")
def group_totals(t):
    rows = t.lineitem.withColumn("flag", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")))
    rows = attach_totals(rows, ["l_orderkey"], {
        "q": F.sum("l_quantity"), "lines": F.count(F.lit(1)),
        "returned": F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)),
        "last_shipped": F.max(F.col("l_shipdate").cast("date")),
    }, nullable=False)
    rows = attach_totals(rows, ["flag"], {"flag_total": F.sum(money("l_extendedprice"))}, few=True)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_quantity") / F.col("q"), 6).alias("share"),
        "lines", "returned", "last_shipped", "flag_total",
    )
