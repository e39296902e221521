"""Table maintenance on the test tables: reference upsert, duplicates, column relations, waiting sessions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..operators import dedupe, locks, relations
from ..plans import reference
from ..session import cut_lineage
from .registry import AS_OF, query, text
from .stock import QUANTITY


def item_tables(t):
    padded = F.lpad(text("p_partkey"), 9, "0")
    stored = t.part.where(F.col("p_type") != "SMALL").select(
        padded.alias("code"), F.col("p_brand").alias("article"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 5, F.lit("old")).alias("unit"),
        F.when(F.col("p_size") < 10, F.lit(None)).when(F.col("p_size") < 15, 0).otherwise(F.col("p_size")).cast(QUANTITY).alias("weight"),
        F.lit(100).alias("factor"))
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).where(F.col("l_returnflag") != "R")
    incoming = rows.select(
        text("p_partkey").alias("code"), F.concat("p_brand", F.lit(".0")).alias("article"), F.col("p_name").alias("name"), F.col("l_linestatus").alias("unit"),
        F.when((F.col("p_size") < 3) & (F.col("l_linenumber") == 1), F.lit(None)).otherwise(F.col("l_quantity")).cast(QUANTITY).alias("weight"))
    return stored, incoming


@query("""
WITH stored AS (
  SELECT lpad(p_partkey::VARCHAR, 9, '0') AS code, p_brand AS article, p_name AS name, CASE WHEN p_size > 5 THEN 'old' END AS unit,
         CASE WHEN p_size < 10 THEN NULL WHEN p_size < 15 THEN 0 ELSE p_size END AS weight, 100 AS factor FROM part WHERE p_type <> 'SMALL'),
incoming AS (
  SELECT lpad(code, 9, '0') AS code, article, name, unit, weight FROM (
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY weight DESC NULLS FIRST, article DESC, name DESC, unit DESC) AS rn FROM (
      SELECT p_partkey::VARCHAR AS code, p_brand AS article, p_name AS name, l_linestatus AS unit,
             CASE WHEN p_size < 3 AND l_linenumber = 1 THEN NULL ELSE l_quantity END AS weight
      FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'R')) WHERE rn = 1)
SELECT s.code, s.article, s.name, CASE WHEN i.code IS NOT NULL AND (s.weight IS NULL OR s.weight = 0) THEN i.unit ELSE s.unit END AS unit,
       (CASE WHEN i.code IS NOT NULL AND (s.weight IS NULL OR s.weight = 0) THEN i.weight ELSE s.weight END)::DOUBLE AS weight, s.factor::BIGINT AS factor
FROM stored s LEFT JOIN incoming i ON i.code = s.code
UNION ALL
SELECT code, article, name, unit, weight::DOUBLE, 350 FROM incoming WHERE code NOT IN (SELECT code FROM stored)
""")
def upsert_fill(t):
    stored, incoming = item_tables(t)
    return reference.update_item_reference(stored, reference.import_items(incoming))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate::DATE::VARCHAR AS shipped FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS FIRST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC) AS rn
  FROM lineitem) WHERE rn = 1
""")
def dedupe_tables(t):
    cleaned = dedupe.keep_newest(t.lineitem, "l_shipdate", ["l_orderkey", "l_linenumber"])
    return cleaned.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("l_shipdate").cast("date").alias("shipped"))


@query(f"""
SELECT * FROM (
  SELECT 'lineitem' AS table_name, count(*) AS rows_all, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_distinct FROM lineitem
  UNION ALL SELECT 'orders', count(*), (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders)) FROM orders
  UNION ALL SELECT 'events', count(*), (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (ts) FROM events)) FROM events)
CROSS JOIN (SELECT '{AS_OF} 00:00:00' AS logged_at), LATERAL (SELECT rows_all - rows_distinct AS rows_removed) WHERE rows_removed > 0
""")
def duplicate_log(t):
    tables = {"lineitem": t.lineitem, "orders": t.orders.drop("o_orderkey", "o_totalprice"), "events": t.events}
    stamps = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
    same = {name: df.withColumnRenamed(stamps[name], "update_date") for name, df in tables.items()}
    return dedupe.dedupe_tables(same, "update_date", datetime.fromisoformat(AS_OF), {"lineitem": ["l_orderkey", "l_linenumber"]})[1]


RELATED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey"], "supplier": ["s_suppkey", "s_nationkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
}
VALUES_SQL = " UNION ALL ".join(
    f"SELECT DISTINCT '{name}' AS t, '{c}' AS c, CASE WHEN {c} = 0 THEN NULL ELSE {c} + {i} * 100000000 END AS v FROM {name}"
    if c in ("o_orderkey", "l_orderkey") else f"SELECT DISTINCT '{name}' AS t, '{c}' AS c, {c} AS v FROM {name}"
    for name, columns in KEYS.items() for i, c in enumerate(columns, 1))
PAIRS_SQL = f"""
v AS ({VALUES_SQL}),
pairs AS (SELECT DISTINCT a.t AS table_name, a.c AS column_name, b.t AS rel_table_name, b.c AS rel_column_name FROM v a JOIN v b ON a.v = b.v AND a.t <> b.t)
"""


def related_tables(t):
    """Order keys are moved out of the range of the other keys, so they relate to each other only."""
    tables = {name: t[name] for name in RELATED}
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        tables[name] = tables[name].withColumn(key, F.when(F.col(key) != 0, F.col(key) + 100000000))
    return tables, relations.candidate_columns(tables, suffix="key")


LONELY_SQL = """
SELECT * FROM chosen UNION ALL
SELECT t, c, NULL, NULL FROM (SELECT DISTINCT t, c FROM v) WHERE (t, c) NOT IN (SELECT (table_name, column_name) FROM chosen)
"""


@query(f"WITH {PAIRS_SQL}, chosen AS (SELECT * FROM pairs) {LONELY_SQL}")
def column_relations(t):
    return relations.column_relations(*related_tables(t))


@query(f"WITH {PAIRS_SQL}, chosen AS (SELECT * FROM pairs WHERE table_name IN ('orders', 'region') OR rel_table_name IN ('orders', 'region')) {LONELY_SQL}")
def relations_increment(t):
    """The relations of tables that the stored rows do not cover, found from the stored values of the others."""
    tables, candidates = related_tables(t)
    earlier = {name: df for name, df in tables.items() if name not in ("orders", "region")}
    known = {name: candidates[name] for name in earlier}
    index, stored = cut_lineage(relations.index_values(earlier, known)), cut_lineage(relations.column_relations(earlier, known))
    new = {name: tables[name] for name in relations.tables_not_covered(list(tables), stored)}
    pairs = relations.pairs_with_new(index, relations.index_values(new, {name: candidates[name] for name in new}))
    return relations.with_lonely(pairs, relations.catalog_frame(t.spark, candidates))


PROBED = [
    ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_returnflag", "orders", "o_orderstatus"),
    ("lineitem", "l_linestatus", "orders", "o_orderstatus"), ("part", "p_name", "customer", "c_name"), ("events", "event_id", "part", "p_partkey"),
]


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS table_name, '{b}' AS column_name, '{c}' AS rel_table_name, '{d}' AS rel_column_name, "
    f"(EXISTS (SELECT 1 FROM {a} x JOIN {c} y ON x.{b} = y.{d} AND x.{b}::VARCHAR <> '{fixed.ZERO_REF}'))::BIGINT AS related" for a, b, c, d in PROBED))
def pair_probe(t):
    return relations.probe_pairs({name: t[name] for pair in PROBED for name in pair[::2]}, PROBED)


@query(f"""
WITH {PAIRS_SQL}
SELECT table_name, column_name, string_agg(rel_table_name || '.' || rel_column_name, '; ' ORDER BY rel_table_name || '.' || rel_column_name) AS comment
FROM pairs GROUP BY ALL
""")
def data_dictionary(t):
    return relations.data_dictionary(relations.column_relations(*related_tables(t)))


@query(f"""
SELECT t AS table_name, c AS column_name FROM (
  SELECT 'lineitem' AS t, 'zero' AS c, CASE WHEN l_quantity > 0 THEN '{fixed.ZERO_REF}' END AS v FROM lineitem
  UNION ALL SELECT 'lineitem', 'flag', CASE WHEN l_returnflag = 'A' THEN '{fixed.ZERO_REF}' ELSE l_returnflag END FROM lineitem
  UNION ALL SELECT 'orders', 'one', 'x' FROM orders)
GROUP BY ALL HAVING count(DISTINCT v) = 1 AND max(v) = '{fixed.ZERO_REF}'
""")
def zero_only_columns(t):
    zero = F.lit(fixed.ZERO_REF)
    tables = {
        "lineitem": t.lineitem.select(F.when(F.col("l_quantity") > 0, zero).alias("zero"),
                                      F.when(F.col("l_returnflag") == "A", zero).otherwise(F.col("l_returnflag")).alias("flag")),
        "orders": t.orders.select(F.lit("x").alias("one")),
    }
    return relations.only_zero_columns(relations.column_values(tables, {"lineitem": ["zero", "flag"], "orders": ["one"]}))


@query("""
WITH locks AS (
  SELECT event_id, user_id, event_type <> 'error' AS granted, date_trunc('hour', ts) AS hour,
         CASE WHEN event_type <> 'view' THEN length(props) END AS page, CASE WHEN value > 10 THEN 'big' END AS tuple FROM events)
SELECT a.event_id, a.user_id, count(*) AS blocking_rows, count(DISTINCT b.user_id) AS blocking_sessions, min(b.user_id) AS first_blocker, max(b.user_id) AS last_blocker
FROM locks a JOIN locks b ON b.hour = a.hour AND b.page IS NOT DISTINCT FROM a.page AND b.tuple IS NOT DISTINCT FROM a.tuple AND b.user_id <> a.user_id
WHERE NOT a.granted GROUP BY a.event_id, a.user_id
""")
def blocking_pairs(t):
    rows = t.events.select(
        "event_id", "user_id", (F.col("event_type") != "error").alias("granted"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"),
        F.when(F.col("event_type") != "view", F.length("props")).alias("page"), F.when(F.col("value") > 10, F.lit("big")).alias("tuple"))
    waiting = locks.blocked_sessions(rows, "user_id", "granted", ["hour", "page", "tuple"])
    return waiting.select("event_id", "user_id", "blocking_rows", "blocking_sessions", "first_blocker", "last_blocker")
