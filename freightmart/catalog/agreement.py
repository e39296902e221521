"""Document agreement and waybills on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..plans import convergence, waybills
from ..session import cut_lineage
from ..sources.tables import calendar
from .recon import LI_SQL, headers, lines
from .registry import money, query, text
from .stock import QUANTITY

YES, NO, AGREED = fixed.YES, fixed.NO, fixed.AGREED

COMMENTS = ["1) нет акта", "2) Некорректное заполнение", "2) Ошибка в коде", "3) Неудовлетворительное качество",
            "3) Несоответствие данных", "4) возврат", "5) отказ", "6) отзыв", "7) период", "8) нет", "9) связи",
            "Системный документ не проведен вовремя"]
COMMENT_SQL = "CASE " + " ".join(f"WHEN n = {i} THEN '{c}'" for i, c in enumerate(COMMENTS, 1)) + " END"

ARCHIVE_SQL = f"""
SELECT line_doc AS archive_id, CASE WHEN lines < 6 THEN 'D' || line_doc END AS archive_document,
       CASE WHEN tax > 0.07 THEN 'Да' ELSE 'Нет' END AS archive_deleted,
       CASE WHEN flag = 'N' THEN '{{no_file}}' ELSE '{{file}}' END AS has_file,
       CASE WHEN discount > 0 THEN 'Согласован' ELSE 'На проверке' END AS approval_own, 'Согласован' AS approval_office,
       CASE WHEN flag = 'A' THEN 'Согласован' ELSE {COMMENT_SQL} END AS comment
FROM (SELECT line_doc, count(*) AS lines, min(l_tax) AS tax, min(l_returnflag) AS flag, min(l_discount) AS discount,
             min(l_linenumber) + count(*) AS n FROM ({LI_SQL}) GROUP BY line_doc)
"""


def archive_table(li, file: str, no_file: str):
    rows = li.groupBy("line_doc").agg(
        F.count(F.lit(1)).alias("lines"), F.min("l_tax").alias("tax"), F.min("l_returnflag").alias("flag"),
        F.min("l_discount").alias("discount"), (F.min("l_linenumber") + F.count(F.lit(1))).alias("n"))
    comment = None
    for i, value in enumerate(COMMENTS, 1):
        comment = F.when(F.col("n") == i, F.lit(value)) if comment is None else comment.when(F.col("n") == i, F.lit(value))
    return rows.select(
        F.col("line_doc").alias("archive_id"), F.when(F.col("lines") < 6, F.concat(F.lit("D"), "line_doc")).alias("archive_document"),
        F.when(F.col("tax") > 0.07, F.lit(YES)).otherwise(F.lit(NO)).alias("archive_deleted"),
        F.when(F.col("flag") == "N", F.lit(no_file)).otherwise(F.lit(file)).alias("has_file"),
        F.when(F.col("discount") > 0, F.lit(AGREED)).otherwise(F.lit("На проверке")).alias("approval_own"),
        F.lit(AGREED).alias("approval_office"),
        F.when(F.col("flag") == "A", F.lit(AGREED)).otherwise(comment).alias("comment"),
    )


def issued(t, li):
    issues = headers(li, "flag_doc", "I", order=F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(fixed.ZERO_REF)).otherwise(F.col("order")),
                     deleted=F.lit(False))
    issue_lines = li.select(F.col("flag_doc").alias("doc"), "item", "quantity")
    items = t.part.select(text("p_partkey").alias("ref"), F.concat(F.lit("N"), text("p_partkey")).alias("item_id"))
    return convergence.issued_per_order(issues, issue_lines, items)


ISSUED_SQL = """
SELECT min(l_orderkey::VARCHAR) AS ref, 'I' || flag_doc AS issue_number, 'N' || item AS item_id, sum(l_quantity) AS quantity
FROM li GROUP BY flag_doc, item HAVING min(o_orderpriority) <> '3-MEDIUM'
"""
PARTNER_SQL = """
SELECT 'E' || l_orderkey AS partner_id, CASE WHEN l_discount > 0.08 THEN 'Да' ELSE 'Нет' END AS partner_deleted,
       CASE WHEN l_tax > 0.06 THEN 'Да' ELSE 'Нет' END AS receipt_deleted, CASE WHEN l_tax < 0.02 THEN 'Нет' ELSE 'Да' END AS partner_posted,
       'N' || item AS partner_item, l_quantity AS partner_quantity, line_doc AS archive_id
FROM li WHERE l_linenumber <> 4
"""


def partner_table(li):
    return li.where(F.col("l_linenumber") != 4).select(
        F.concat(F.lit("E"), "order").alias("partner_id"),
        F.when(F.col("l_discount") > 0.08, F.lit(YES)).otherwise(F.lit(NO)).alias("partner_deleted"),
        F.when(F.col("l_tax") > 0.06, F.lit(YES)).otherwise(F.lit(NO)).alias("receipt_deleted"),
        F.when(F.col("l_tax") < 0.02, F.lit(NO)).otherwise(F.lit(YES)).alias("partner_posted"),
        F.concat(F.lit("N"), "item").alias("partner_item"), F.col("quantity").alias("partner_quantity"),
        F.col("line_doc").alias("archive_id"))


def _ladder_sql(head: list[tuple[str, str, str]], comments, tail: list[tuple[str, str, str]], pick: int) -> str:
    rules = head + [(f"comment LIKE '{p}'", c, x) for p, c, x in comments] + tail
    return "CASE " + " ".join(f"WHEN {r[0]} THEN '{r[pick]}'" for r in rules)


_4PL_HEAD = [
    ("NOT deleted AND partner_deleted = 'Да'", "1", convergence.DELETED_THERE),
    ("warehouse IS NULL AND partner_id IS NULL", "1", convergence.DELETED_THERE),
    ("cancelled AND partner_deleted = 'Нет'", "2", convergence.CANCELLED_HERE),
    ("receipt_deleted = 'Да'", "3", convergence.RECEIPT_DELETED), ("quantity - partner_quantity <> 0", "4", convergence.QUANTITY),
    ("archive_document IS NULL", "5", convergence.NO_ARCHIVE), ("has_file = 'Нет'", "6", convergence.NO_SCAN),
    ("order_id IS NULL OR partner_id IS NULL", "7", convergence.UNKNOWN_ITEM),
]
_4PL_TAIL = [("NOT deleted AND NOT cancelled AND NOT posted", "16", convergence.NOT_POSTED_HERE)]
_4PL_OUT = ["error", "error_code", "ref", "order_id", "warehouse", "issue_number", "item_id", "quantity", "partner_id",
            "partner_deleted", "receipt_deleted", "partner_item", "partner_quantity", "archive_document", "comment", "order_warehouse"]


@query(f"""
WITH li AS ({LI_SQL}), issued AS ({ISSUED_SQL}), partner AS ({PARTNER_SQL}),
archive AS ({ARCHIVE_SQL.format(file=YES, no_file=NO)}),
orders4 AS (
  SELECT o_orderkey::VARCHAR AS ref, CASE WHEN o_orderpriority <> '5-LOW' THEN 'E' || o_orderkey END AS order_id,
         CASE WHEN o_totalprice <= 450000 THEN o_custkey::VARCHAR END AS warehouse,
         o_orderstatus = 'P' AND o_totalprice > 100000 AS deleted, o_orderpriority = '4-NOT SPECIFIED' AS cancelled, o_totalprice > 60000 AS posted
  FROM orders),
svod AS (
  SELECT CASE WHEN NOT deleted AND NOT cancelled AND posted AND quantity = partner_quantity AND partner_deleted = 'Нет'
                   AND receipt_deleted = 'Нет' AND archive_deleted = 'Нет' AND has_file = 'Да' AND approval_own = 'Согласован'
                   AND approval_office = 'Согласован' AND comment = 'Согласован' THEN 'Нет'
              WHEN cancelled AND partner_id IS NULL THEN 'Нет' WHEN deleted AND partner_deleted = 'Да' THEN 'Нет'
              WHEN cancelled AND posted AND receipt_deleted = 'Да' AND archive_deleted = 'Да' THEN 'Нет' ELSE 'Да' END AS has_error, *
  FROM (SELECT orders4.*, issue_number, item_id, quantity FROM orders4 LEFT JOIN issued ON issued.ref = orders4.ref) own
  LEFT JOIN (SELECT partner.*, archive.* EXCLUDE (archive_id) FROM partner LEFT JOIN archive USING (archive_id)) other
    ON order_id = partner_id AND item_id = partner_item)
SELECT {_ladder_sql(_4PL_HEAD, convergence.COMMENTS_4PL, _4PL_TAIL, 2)} ELSE 'Прочие ошибки' END AS error,
       {_ladder_sql(_4PL_HEAD, convergence.COMMENTS_4PL, _4PL_TAIL, 1)} ELSE '17' END AS error_code,
       svod.ref, svod.order_id, svod.warehouse, issue_number, item_id, quantity::DOUBLE AS quantity, partner_id, partner_deleted, receipt_deleted,
       partner_item, partner_quantity::DOUBLE AS partner_quantity, archive_document, comment, order_warehouse
FROM svod LEFT JOIN (SELECT order_id AS z_id, warehouse AS order_warehouse FROM orders4) z ON z_id = coalesce(svod.order_id, svod.partner_id)
WHERE has_error = 'Да'
""")
def convergence_4pl(t):
    li = lines(t)
    priority, total = F.col("o_orderpriority"), F.col("o_totalprice")
    orders = t.orders.select(
        text("o_orderkey").alias("ref"), F.when(priority != "5-LOW", F.concat(F.lit("E"), text("o_orderkey"))).alias("order_id"),
        F.when(total <= 450000, text("o_custkey")).alias("warehouse"), ((F.col("o_orderstatus") == "P") & (total > 100000)).alias("deleted"),
        (priority == "4-NOT SPECIFIED").alias("cancelled"), (total > 60000).alias("posted"))
    rows = convergence.convergence_4pl(orders, issued(t, li), partner_table(li), archive_table(li, YES, NO))
    return rows.select(*_4PL_OUT)


_OWN_HEAD = [
    ("NOT deleted AND partner_id IS NULL", "1", convergence.DELETED_THERE),
    ("NOT deleted AND partner_id IS NOT NULL AND partner_deleted = 'Да'", "1", convergence.DELETED_THERE),
    ("deleted AND partner_deleted = 'Нет'", "2", convergence.CANCELLED_HERE),
    ("quantity <> partner_quantity", "3", convergence.QUANTITY),
    ("NOT deleted AND partner_id IS NOT NULL AND partner_deleted = 'Нет' AND archive_document IS NULL", "4", convergence.NO_ARCHIVE),
    ("NOT deleted AND partner_id IS NOT NULL AND partner_deleted = 'Нет' AND archive_document IS NOT NULL AND has_file = 'Нет файла'",
     "5", convergence.NO_SCAN),
]
_OWN_TAIL = [
    ("approval_office <> 'Согласован'", "17", convergence.OTHER_ERRORS),
    ("NOT deleted AND partner_deleted = 'Нет' AND partner_posted = 'Нет'", "16", convergence.NOT_POSTED_THERE),
]


@query(f"""
WITH li AS ({LI_SQL}), issued AS ({ISSUED_SQL}), partner AS ({PARTNER_SQL}),
archive AS ({ARCHIVE_SQL.format(file='Есть файл', no_file='Нет файла')}),
own AS (
  SELECT *, row_number() OVER (PARTITION BY order_id, item_id ORDER BY quantity, deleted, issue_deleted, issue_number, warehouse) AS position FROM (
    SELECT 'E' || o_orderkey AS order_id, o_custkey::VARCHAR AS warehouse, o_orderstatus = 'P' AS deleted, issue_number, item_id, quantity,
           false AS issue_deleted
    FROM orders LEFT JOIN issued ON ref = o_orderkey::VARCHAR)),
lt AS (
  SELECT *, row_number() OVER (PARTITION BY partner_id, partner_item ORDER BY partner_quantity, partner_deleted, receipt_deleted,
           partner_posted, archive_document, archive_deleted, has_file, approval_own, approval_office, comment) AS n
  FROM partner LEFT JOIN archive USING (archive_id)),
svod AS (
  SELECT CASE WHEN NOT deleted AND quantity = partner_quantity AND partner_deleted = 'Нет' AND partner_posted = 'Да' AND has_file = 'Есть файл'
                   AND approval_own = 'Согласован' AND approval_office = 'Согласован' AND comment = 'Согласован' THEN 'Нет'
              WHEN deleted AND partner_id IS NULL THEN 'Нет' WHEN deleted AND partner_deleted = 'Да' AND archive_document IS NULL THEN 'Нет'
              WHEN deleted AND partner_deleted = 'Да' AND archive_document IS NOT NULL AND approval_own = 'Согласован'
                   AND approval_office = 'Согласован' AND comment = 'Согласован' THEN 'Нет' ELSE 'Да' END AS has_error, *
  FROM own LEFT JOIN lt ON order_id = partner_id AND item_id = partner_item AND position = n)
SELECT {_ladder_sql(_OWN_HEAD, convergence.COMMENTS_OWN, _OWN_TAIL, 2)} END AS error,
       {_ladder_sql(_OWN_HEAD, convergence.COMMENTS_OWN, _OWN_TAIL, 1)} END AS error_code,
       order_id, warehouse, issue_number, item_id, quantity::DOUBLE AS quantity, position, partner_id, partner_deleted, partner_posted,
       partner_quantity::DOUBLE AS partner_quantity, archive_document, comment
FROM svod WHERE has_error = 'Да'
""")
def convergence_oh(t):
    li = lines(t)
    orders = t.orders.select(
        text("o_orderkey").alias("ref"), F.concat(F.lit("E"), text("o_orderkey")).alias("order_id"),
        text("o_custkey").alias("warehouse"), (F.col("o_orderstatus") == "P").alias("deleted"))
    rows = convergence.convergence_own_storage(
        orders, issued(t, li), partner_table(li), archive_table(li, "Есть файл", "Нет файла"))
    return rows.select("error", "error_code", "order_id", "warehouse", "issue_number", "item_id", "quantity", "position", "partner_id",
                       "partner_deleted", "partner_posted", "partner_quantity", "archive_document", "comment")


_MOVE_HEAD = [("archive_document IS NULL", "1", convergence.NO_ARCHIVE), ("archive_deleted = 'Да'", "2", convergence.ARCHIVE_DELETED),
              ("has_file = 'Нет'", "3", convergence.NO_SCAN)]


@query(f"""
WITH archive AS ({ARCHIVE_SQL.format(file=YES, no_file=NO)}),
moves AS (
  SELECT line_doc AS archive_id, l_linenumber, item, l_suppkey, l_quantity AS quantity,
         CASE l_returnflag WHEN 'A' THEN 'Перемещение товаров' WHEN 'R' THEN 'Отгрузка товаров с хранения' ELSE 'Прочее' END AS kind,
         CASE WHEN l_discount > 0.08 THEN 'Да' ELSE 'Нет' END AS deleted, CASE WHEN l_tax < 0.02 THEN 'Нет' ELSE 'Да' END AS posted
  FROM ({LI_SQL}))
SELECT {_ladder_sql(_MOVE_HEAD, convergence.COMMENTS_MOVES, [], 2)} ELSE 'Прочие ошибки' END AS error,
       {_ladder_sql(_MOVE_HEAD, convergence.COMMENTS_MOVES, [], 1)} ELSE '12' END AS error_code,
       archive_id AS document_id, kind, deleted, posted, l_linenumber, item, l_suppkey, quantity, archive_document, archive_deleted, comment
FROM moves LEFT JOIN archive USING (archive_id)
WHERE kind IN ('Перемещение товаров', 'Отгрузка товаров с хранения')
  AND NOT coalesce(posted = 'Да' AND deleted = 'Нет' AND has_file = 'Да' AND archive_deleted = 'Нет' AND approval_own = 'Согласован'
                   AND approval_office = 'Согласован' AND comment = 'Согласован', false)
""")
def convergence_mpi(t):
    li = lines(t)
    flag = F.col("l_returnflag")
    suppliers = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linestatus").alias("document_id"), "l_linenumber", text("l_partkey").alias("item"), "l_suppkey",
        F.col("l_quantity").cast(QUANTITY).alias("quantity"),
        F.when(flag == "A", F.lit("Перемещение товаров")).when(flag == "R", F.lit("Отгрузка товаров с хранения"))
        .otherwise(F.lit("Прочее")).alias("kind"),
        F.when(F.col("l_discount") > 0.08, F.lit(YES)).otherwise(F.lit(NO)).alias("deleted"),
        F.when(F.col("l_tax") < 0.02, F.lit(NO)).otherwise(F.lit(YES)).alias("posted"))
    archive = archive_table(li, YES, NO).withColumnRenamed("archive_id", "document_id")
    rows = convergence.convergence_movements(suppliers, archive)
    return rows.select("error", "error_code", "document_id", "kind", "deleted", "posted", "l_linenumber", "item", "l_suppkey", "quantity",
                       "archive_document", "archive_deleted", "comment")


def waybill_tables(t):
    # every table of the waybills is made of the same lines, which are joined once and kept
    rows = cut_lineage(t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate"))
    flag, priority = F.col("l_returnflag"), F.col("o_orderpriority")
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    old = F.col("l_shipdate") - F.expr("INTERVAL 1975 YEARS")
    routes = t.orders.select(
        text("o_orderkey").alias("ref"), F.concat(F.lit("ML"), text("o_orderkey")).alias("number"), F.col("o_orderdate").alias("day"),
        F.when(priority == "5-LOW", F.lit("x")).otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderdate").alias("unloaded_at"),
        (F.col("o_totalprice") > 480000).alias("deleted"), F.lit(True).alias("posted"))
    statuses = t.orders.select(F.col("o_orderstatus").alias("ref")).distinct().select(
        "ref", F.when(F.col("ref") == "P", F.lit(fixed.CANCELLED_BY_CUSTOMER)).otherwise(F.col("ref")).alias("name"))
    route_lines = rows.groupBy(text("l_orderkey").alias("route"), text("l_partkey").alias("request")).agg(
        F.min("l_linestatus").alias("load_place"), F.min(F.when(flag == "N", F.lit("")).otherwise(flag)).alias("unload_place"),
        F.min(F.when(flag == "A", old).otherwise(F.col("l_shipdate"))).alias("loaded_at"), F.max("l_shipdate").alias("line_unloaded_at"))
    requests = t.part.select(
        text("p_partkey").alias("ref"), F.when(F.col("p_size") > 3, F.concat(F.lit("Z"), text("p_partkey"))).alias("number"),
        (F.col("p_type") == "PROMO").alias("deleted"), F.lit(True).alias("posted"))
    packages = rows.where(F.col("l_linestatus") == "F").select(
        key.alias("package"), text("l_orderkey").alias("route"), text("l_partkey").alias("request"), F.col("l_shipdate").alias("received_at"),
        F.when(flag == "A", True).when(flag == "R", False).alias("is_valid"), (F.col("l_tax") > 0.03).alias("processed"),
        F.concat(F.lit("e"), F.col("l_linenumber").cast("string")).alias("error"))
    sales = rows.where(F.col("l_linestatus") == "O").select(
        key.alias("ref"), F.concat(F.lit(" "), key).alias("number"), F.col("l_shipdate").alias("day"), text("l_orderkey").alias("route"),
        text("l_partkey").alias("request"), money("l_extendedprice").alias("amount"))
    register = rows.where(F.col("l_linestatus") == "O").select(
        F.when(F.col("l_linenumber") == 1, F.lit(fixed.ZERO_REF)).otherwise(key).alias("document"),
        F.explode(F.array(F.struct(F.lit("R").alias("status"), F.col("l_shipdate").alias("period")),
                          F.struct(flag.alias("status"), F.col("o_orderdate").alias("period")))).alias("x")).select("document", "x.status", "x.period")
    names = t.lineitem.select(F.col("l_returnflag").alias("ref")).distinct().where(F.col("ref") != "A").select(
        "ref", F.concat(F.lit("status "), "ref").alias("name"))
    return routes, route_lines, requests, statuses, packages, sales, register, names


WAYBILL_SQL = """
routes AS (SELECT o_orderkey AS ref, 'ML' || o_orderkey AS number, o_orderdate AS day, o_orderstatus, o_orderpriority, o_totalprice FROM orders),
rl AS (
  SELECT l_orderkey AS route, l_partkey AS request, min(l_linestatus) AS load_place,
         min(CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END) AS unload_place,
         min(CASE WHEN l_returnflag = 'A' THEN l_shipdate - INTERVAL 1975 YEAR ELSE l_shipdate END) AS loaded_at,
         max(l_shipdate) AS line_unloaded_at FROM lineitem GROUP BY ALL),
requests AS (SELECT p_partkey AS ref, CASE WHEN p_size > 3 THEN 'Z' || p_partkey END AS number, p_type FROM part),
li AS (SELECT *, concat_ws('-', l_orderkey, l_partkey, l_linenumber, l_suppkey) AS k FROM lineitem),
soika AS (
  SELECT * FROM (
    SELECT coalesce(routes.number, '         ') || '/' || coalesce(requests.number, '         ') AS key, k AS package, l_shipdate AS received_at,
           CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS is_valid, l_tax > 0.03 AS processed, 'e' || l_linenumber AS error,
           row_number() OVER (PARTITION BY routes.number || '/' || requests.number
             ORDER BY CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END DESC NULLS FIRST, l_shipdate DESC NULLS FIRST, k DESC) AS rn
    FROM li LEFT JOIN routes ON routes.ref = l_orderkey LEFT JOIN requests ON requests.ref = l_partkey
    WHERE l_linestatus = 'F') WHERE rn = 1)
"""


@query(f"""
WITH {WAYBILL_SQL}
SELECT key, package, strftime(received_at, '%Y-%m-%d %H:%M:%S') AS received_at, is_valid::BIGINT AS is_valid, processed::BIGINT AS processed, error
FROM soika
""")
def incoming_packages(t):
    routes, route_lines, requests, _, packages, *_ = waybill_tables(t)
    return waybills.incoming_packages(packages, routes, route_lines, requests)


@query(f"""
WITH {WAYBILL_SQL},
base AS (
  SELECT routes.number AS route_number, requests.number AS request_number, routes.day, o_orderstatus AS route_status, route, request, load_place,
         unload_place, loaded_at, line_unloaded_at,
         coalesce(routes.number, '         ') || '/' || coalesce(requests.number, '         ') AS key
  FROM routes JOIN rl ON rl.route = routes.ref JOIN requests ON requests.ref = rl.request
  WHERE day > TIMESTAMP '1996-06-01' AND NOT o_totalprice > 480000 AND o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' AND p_type <> 'PROMO'),
reg AS (
  SELECT k AS document, 'R' AS status, l_shipdate AS period FROM li WHERE l_linestatus = 'O'
  UNION ALL SELECT k, l_returnflag, o_orderdate FROM li JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus = 'O'),
named AS (SELECT document, period, CASE WHEN status <> 'A' THEN 'status ' || status END AS name FROM reg),
edo AS (SELECT document, name AS electronic_status FROM (SELECT *, row_number() OVER (PARTITION BY document
          ORDER BY period DESC NULLS FIRST, name DESC NULLS FIRST) AS rn FROM named
          WHERE document NOT IN (SELECT k FROM li WHERE l_linenumber = 1)) WHERE rn = 1),
bum AS (SELECT document, name AS paper_status FROM (SELECT *, row_number() OVER (PARTITION BY document
          ORDER BY period DESC NULLS FIRST, name DESC NULLS FIRST) AS rn FROM named
          WHERE document NOT IN (SELECT k FROM li WHERE l_linenumber = 1) AND name IS NOT NULL) WHERE rn = 1),
rtu AS (
  SELECT coalesce(routes.number, '         ') || '/' || coalesce(requests.number, '         ') AS sale_key,
         'РТУ №' || trim(' ' || k) || ' от ' || l_shipdate::DATE::VARCHAR AS sale, l_shipdate AS sale_day, l_extendedprice AS amount,
         electronic_status, paper_status
  FROM li LEFT JOIN routes ON routes.ref = l_orderkey LEFT JOIN requests ON requests.ref = l_partkey
  LEFT JOIN edo ON edo.document = k LEFT JOIN bum ON bum.document = k
  WHERE l_linestatus = 'O' AND l_partkey IN (SELECT request FROM base))
SELECT base.key, route_number, request_number, route_status, load_place, unload_place,
       strftime(CASE WHEN year(loaded_at) < 1000 THEN loaded_at + INTERVAL 2000 YEAR ELSE loaded_at END, '%Y-%m-%d %H:%M:%S') AS loaded_at,
       strftime(line_unloaded_at, '%Y-%m-%d %H:%M:%S') AS line_unloaded_at,
       CASE WHEN soika.key IS NOT NULL THEN 'да' ELSE 'нет' END AS package_received,
       CASE WHEN processed THEN 'да' ELSE 'нет' END AS package_processed, coalesce(is_valid, false)::BIGINT AS is_valid,
       soika.key AS package_key, package, error, sale_key, sale, amount, electronic_status, paper_status,
       strftime(base.day, '%Y-%m') AS year_month, base.day::DATE::VARCHAR AS date
FROM base LEFT JOIN soika ON trim(soika.key) = trim(base.key) LEFT JOIN rtu ON trim(sale_key) = trim(base.key)
WHERE unload_place <> ''
""")
def edi_status(t):
    routes, route_lines, requests, statuses, packages, sales, register, names = waybill_tables(t)
    # the base is met twice; what is joined in the end is kept, so that only one part's shuffles are on disk at a time
    base = cut_lineage(waybills.route_base(routes, route_lines, requests, statuses, "1996-06-01"))
    electronic = waybills.electronic_documents(register, names)
    paper = waybills.latest_status(register, names, "paper_status", must_have_name=True)
    packs = cut_lineage(waybills.incoming_packages(packages, routes, route_lines, requests))
    sold = cut_lineage(waybills.sales_documents(sales, base, routes, route_lines, requests, cut_lineage(electronic), cut_lineage(paper)))
    rows = waybills.waybill_status(base, packs, sold, calendar(t.spark, "1995-01-01", "2002-12-31"))
    return rows.select(
        "key", "route_number", "request_number", "route_status", "load_place", "unload_place", "loaded_at", "line_unloaded_at",
        "package_received", "package_processed", "is_valid", "package_key", "package", "error", "sale_key", "sale", "amount",
        "electronic_status", "paper_status", "year_month", "date")
