"""Stock, prices and warehouses on the test tables.

Line items play the movement ledger (returned lines are issues), parts the
items, suppliers the warehouses.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..operators.ledger import calendar_months, monthly_balance as balance_by_month, months, signed
from ..plans import prices, stock, warehouses
from ..sources.tables import calendar
from .columns import ACRONYM_SQL
from .registry import AS_OF, money, query, text

END = date.fromisoformat(AS_OF)
QUANTITY = "decimal(18,2)"


@query("""
WITH ledger AS (
  SELECT l_suppkey, p_type, date_trunc('month', l_shipdate)::DATE AS moved,
         sum(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * l_quantity::DECIMAL(18,2)) AS net
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
balances AS (
  SELECT *, sum(net) OVER w AS balance, lead(moved, 1, DATE '2002-01-01') OVER w AS until
  FROM ledger WINDOW w AS (PARTITION BY l_suppkey, p_type ORDER BY moved)),
calendar AS (SELECT month::DATE AS month FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH) g(month))
SELECT month::VARCHAR AS month, last_day(month)::VARCHAR AS month_end, l_suppkey, p_type, balance::DOUBLE AS balance
FROM calendar JOIN balances ON (moved <= month AND until > month) OR (until = moved AND moved = month)
WHERE balance <> 0
""")
def monthly_balance(t):
    ledger = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "l_suppkey", "p_type", "l_shipdate", F.col("l_quantity").cast(QUANTITY).alias("quantity"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("direction"))
    amount = signed(F.col("direction"), F.col("quantity"))
    return balance_by_month(ledger, ["l_suppkey", "p_type"], "l_shipdate", amount, months(t.spark, date(1995, 1, 1), END), END)


WAREHOUSES = {
    "AUTOMOBILE": "10012 Основной 4PL", "BUILDING": "СУ-021 АБЛ", "FURNITURE": "СО СЛД-12 Рэйл",
    "HOUSEHOLD": "ОП ЦС Делоникс", "MACHINERY": "СОСУ ТМХ-И",
}


def warehouse_tables(t):
    """Customers as warehouses named by segment, nations as branches, regions as departments."""
    segment = F.col("c_mktsegment")
    name = None
    for key, value in WAREHOUSES.items():
        name = F.when(segment == key, F.lit(value)) if name is None else name.when(segment == key, F.lit(value))
    zero = F.lit(fixed.ZERO_REF)
    houses = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        text("c_custkey").alias("ref"),
        F.when(F.col("c_acctbal") > 9000, F.col("c_name")).otherwise(F.concat(name, F.lit(" "), F.col("c_name"))).alias("name"),
        F.when(F.col("c_acctbal") < 2000, zero).otherwise(text("c_nationkey")).alias("usage"),
        text("n_nationkey").alias("branch"),
        F.when(F.col("c_acctbal") < 0, zero).otherwise(text("n_regionkey")).alias("department"),
        F.when(segment == "BUILDING", zero).otherwise(text("c_custkey")).alias("person"),
        (F.col("c_acctbal") > 9800).alias("deleted"), (F.col("c_acctbal") <= 9900).alias("is_group"),
    )
    branches = t.nation.select(text("n_nationkey").alias("ref"), F.concat(F.lit("северо-западный "), "n_name").alias("name"))
    departments = t.region.select(text("r_regionkey").alias("ref"), F.col("r_name").alias("name"))
    people = t.customer.where(F.col("c_acctbal") > 500).select(text("c_custkey").alias("ref"), F.col("c_name").alias("name"))
    return houses, branches, departments, people


def classes(t):
    return warehouses.classify_warehouses(*warehouse_tables(t))


WAREHOUSE_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in WAREHOUSES.items()) + " END"
CLASSES_SQL = f"""
SELECT warehouse_ref, name AS warehouse,
       CASE WHEN name LIKE '%4%PL%' THEN '4PL' ELSE 'ОХ' END AS format,
       CASE WHEN name LIKE '%АБЛ%' THEN 'АБЛ' WHEN name LIKE '%Рэйл%' THEN 'АБЛ' WHEN name LIKE '%Делоникс%' THEN 'АБЛ'
            WHEN name LIKE '%ТМХ-И%' THEN 'АБЛ' WHEN c_acctbal < 2000 THEN 'ЖДРМ' ELSE 'ЛТС' END AS owner,
       CASE WHEN name LIKE '%СЛД-%' THEN 'СЛД' WHEN name LIKE '%СО%' THEN 'СО' WHEN name LIKE '%СУ%' THEN 'СУ'
            WHEN name LIKE '%ЦС%' OR name LIKE '%ОП%' THEN 'ЦС' ELSE 'ЗАВОД' END AS kind,
       branch, {ACRONYM_SQL.format('branch')} AS branch_short, r_name AS department,
       coalesce(CASE WHEN c_mktsegment <> 'BUILDING' AND c_acctbal > 500 THEN c_name END, 'Заводы ЖДРМ') AS person
FROM (SELECT c.*, c_custkey::VARCHAR AS warehouse_ref, 'северо-западный ' || n_name AS branch, r_name,
             CASE WHEN c_acctbal > 9000 THEN c_name ELSE {WAREHOUSE_SQL} || ' ' || c_name END AS name
      FROM customer c JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
WHERE NOT c_acctbal > 9800 AND c_acctbal <= 9900 AND c_acctbal >= 0
"""


@query(CLASSES_SQL)
def warehouse_class(t):
    return classes(t)


def price_inputs(t):
    """Catalogue prices for the cheaper sizes; shipments are orders issued from the customer's warehouse."""
    catalogue = t.part.where(F.col("p_size") <= 25).select(
        text("p_partkey").alias("item"),
        F.when(F.col("p_size") == 1, 0).otherwise(money("p_retailprice")).cast("decimal(18,2)").alias("price"),
        F.lit("2001-01-01").cast("timestamp_ntz").alias("period"))
    second = catalogue.where(F.col("price") > 1000).select(
        "item", (F.col("price") + 5).cast("decimal(18,2)").alias("price"), "period")
    lines = t.lineitem.select(
        text("l_orderkey").alias("shipment"), text("l_partkey").alias("item"),
        F.when(F.col("l_linenumber") == 7, 1).otherwise(money("l_extendedprice")).cast("decimal(18,2)").alias("price"))
    links = t.lineitem.select(text("l_orderkey").alias("issue_order"), text("l_orderkey").alias("shipment"))
    orders = t.orders.select(
        text("o_orderkey").alias("ref"), (F.col("o_orderstatus") == "P").alias("deleted"),
        text("o_custkey").alias("warehouse"), F.col("o_orderdate").alias("issued_at"))
    houses = t.customer.select(text("c_custkey").alias("ref"), F.col("c_name").alias("name"))
    mapping = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("name"),
        F.when(F.col("n_regionkey") == 1, F.lit("Консолидация")).when(F.col("n_regionkey") != 2, F.col("n_name")).alias("branch"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("ЦС")).otherwise(F.lit("СУ")).alias("kind"))
    return catalogue.unionByName(second), lines, links, orders, houses, mapping


PRICE_SQL = """
WITH catalogue AS (
  SELECT p_partkey::VARCHAR AS item, CASE WHEN p_size = 1 THEN 0 ELSE p_retailprice END::DECIMAL(18,2) AS price,
         TIMESTAMP '2001-01-01' AS period FROM part WHERE p_size <= 25),
both_prices AS (SELECT * FROM catalogue UNION ALL SELECT item, price + 5, period FROM catalogue WHERE price > 1000),
listed AS (
  SELECT item, price, period::DATE AS price_date FROM (
    SELECT *, {rank} OVER (PARTITION BY item ORDER BY period DESC NULLS FIRST{listed_ties}) AS r FROM both_prices)
  WHERE r = 1 AND {zero}),
sold AS (
  SELECT l_partkey::VARCHAR AS item, CASE WHEN l_linenumber = 7 THEN 1 ELSE l_extendedprice END::DECIMAL(18,2) AS price,
         o_orderdate AS issued_at
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE o_orderstatus <> 'P' AND n_regionkey NOT IN (1, 2) AND c_mktsegment <> 'BUILDING'),
shipped AS (
  SELECT item, price, issued_at::DATE AS price_date FROM (
    SELECT DISTINCT item, price, issued_at, {rank} OVER (PARTITION BY item ORDER BY issued_at DESC NULLS FIRST, price DESC NULLS FIRST) AS r
    FROM sold WHERE price NOT IN (0, 1) AND item NOT IN (SELECT item FROM listed)) WHERE r = 1)
SELECT item, price::DOUBLE AS price, price_date::VARCHAR AS price_date FROM (SELECT * FROM listed UNION SELECT * FROM shipped)
"""


@query(PRICE_SQL.format(rank="rank()", listed_ties="", zero="price <> 0"))
def price_list_rank(t):
    return prices.price_list(*price_inputs(t))


@query(PRICE_SQL.format(rank="row_number()", listed_ties=", price DESC NULLS FIRST", zero="true"))
def price_list_rownum(t):
    return prices.price_list(*price_inputs(t), keep_ties=False, drop_zero=False)


@query(f"""
WITH prices AS ({PRICE_SQL.format(rank="rank()", listed_ties="", zero="price <> 0")}), classes AS ({CLASSES_SQL})
SELECT branch_short, department, warehouse, kind, owner, format, l_shipdate::DATE::VARCHAR AS moved_on,
       coalesce(p_type = 'PROMO', false)::BIGINT AS is_line,
       CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'N' THEN 'kind ' || l_returnflag ELSE 'Свободные остатки' END AS assignment,
       'operation ' || l_linestatus AS operation,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Выкуп' END AS buyout,
       CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS quantity,
       (CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END::DECIMAL(18,2) * prices.price::DECIMAL(18,2))::DOUBLE AS amount
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN part ON p_partkey = l_partkey AND p_size > 5
LEFT JOIN prices ON prices.item = l_partkey::VARCHAR
LEFT JOIN classes ON warehouse_ref = o_custkey::VARCHAR
WHERE year(l_shipdate) = 1998 AND l_linenumber <> 3
""")
def movement_value(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    ledger = rows.select(
        F.col("l_shipdate").alias("period"), text("o_custkey").alias("warehouse"), text("l_partkey").alias("item"),
        F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("assignment"), text("o_orderkey").alias("registrar"),
        F.when(F.col("l_linenumber") == 3, F.lit(fixed.ASSIGNMENT_CORRECTION_TYPE)).otherwise(F.col("l_linestatus")).alias("type"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("direction"), F.col("l_quantity").cast(QUANTITY).alias("quantity"))
    types = t.lineitem.select(F.col("l_linestatus").alias("type")).distinct().select("type", F.concat(F.lit("operation "), "type").alias("name"))
    flags = t.lineitem.where(F.col("l_returnflag") != "N").select(F.col("l_returnflag").alias("ref")).distinct()
    assignments = flags.select("ref", F.concat(F.lit("k"), "ref").alias("kind"))
    kinds = flags.select(F.concat(F.lit("k"), "ref").alias("ref"), F.concat(F.lit("kind "), "ref").alias("name"))
    issues = t.orders.select(text("o_orderkey").alias("ref"), F.when(
        F.col("o_orderpriority") == "1-URGENT", F.lit("Срочный выкуп")).otherwise(F.col("o_orderpriority")).alias("comment"))
    equipment = t.part.where(F.col("p_size") > 5).select(text("p_partkey").alias("ref"), (F.col("p_type") == "PROMO").alias("is_line"))
    listed = prices.price_list(*price_inputs(t))
    return stock.movement_value(ledger, types, assignments, kinds, issues, equipment, listed, classes(t), 1998)


@query("""
WITH net AS (
  SELECT o_custkey, l_partkey, date_trunc('month', l_shipdate)::DATE AS moved,
         sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END) AS net
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority <> '5-LOW' GROUP BY ALL),
named AS (
  SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS warehouse_name, p_brand AS item_code, p_type AS article,
         l_partkey::VARCHAR AS item, p_name AS item_name, moved, sum(net) AS net
  FROM net JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey GROUP BY ALL),
balances AS (
  SELECT *, sum(net) OVER w AS balance, lead(moved, 1, DATE '2002-01-01') OVER w AS until
  FROM named WINDOW w AS (PARTITION BY warehouse_name, item ORDER BY moved)),
calendar AS (SELECT month::DATE AS month FROM generate_series(TIMESTAMP '1999-07-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH) g(month))
SELECT month::VARCHAR AS month, last_day(month)::VARCHAR AS month_end, warehouse_name, item_code, article, item, item_name, balance
FROM calendar JOIN balances ON moved <= month AND until > month WHERE balance <> 0
""")
def month_end_stock(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    ledger = rows.select(
        F.col("l_shipdate").alias("period"),
        F.when(F.col("o_orderpriority") != "5-LOW", text("o_custkey")).alias("warehouse"), text("l_partkey").alias("item"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("direction"), F.col("l_quantity").cast(QUANTITY).alias("quantity"))
    houses = t.customer.select(text("c_custkey").alias("ref"), F.when(
        F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("name"))
    items = t.part.select(text("p_partkey").alias("ref"), F.col("p_brand").alias("code"), F.col("p_type").alias("article"),
                          F.col("p_name").alias("name"))
    days = calendar(t.spark, "1995-01-01", "2001-12-31")
    return stock.month_end_stock(ledger, houses, items, calendar_months(days, "date", date(1999, 7, 15)), END)


@query("""
WITH links AS (
  SELECT s_suppkey AS customer_ref, CASE WHEN s_nationkey = 3 THEN '-' ELSE 'W' || s_nationkey END AS warehouse,
         'B' || (s_nationkey < 10)::INT AS own_base FROM supplier),
lines AS (
  SELECT lineitem.*, p_name, p_type, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey),
a AS (
  SELECT warehouse, p_name AS item, coalesce(CASE WHEN p_type <> 'PROMO' THEN p_type END, p_brand) AS article, p_brand AS code,
         l_partkey AS item_id, CASE l_returnflag WHEN 'R' THEN '' WHEN 'A' THEN '' ELSE 'N' END AS series,
         sum(l_quantity) AS quantity, p_type = 'LARGE' AS is_line
  FROM (SELECT * FROM links WHERE warehouse <> '-') LEFT JOIN (SELECT * FROM lines WHERE l_linestatus = 'F') ON l_suppkey = customer_ref
  GROUP BY ALL),
b AS (
  SELECT links.warehouse, own_base, p_name AS item, p_type AS article, p_brand AS code, l_partkey AS item_id,
         CASE WHEN l_returnflag = 'N' THEN 'N' ELSE '' END AS series, sum(l_quantity + 1234) AS quantity, p_type = 'LARGE' AS is_line
  FROM lines JOIN supplier ON s_suppkey = l_suppkey JOIN (SELECT DISTINCT warehouse, own_base FROM links) links
    ON links.warehouse = 'W' || s_nationkey
  WHERE l_linestatus = 'O' AND l_returnflag <> 'R' GROUP BY ALL)
SELECT coalesce(a.warehouse, b.warehouse) AS warehouse, coalesce(a.item, b.item) AS item, coalesce(a.article, b.article) AS article,
       coalesce(a.code, b.code) AS code, coalesce(a.item_id, b.item_id)::VARCHAR AS item_id,
       CASE WHEN coalesce(a.item, b.item) IS NOT NULL THEN 'pc' END AS unit,
       coalesce(a.series, b.series) AS series, coalesce(a.quantity, 0)::DOUBLE AS customer_quantity,
       coalesce(b.quantity, 0)::DOUBLE AS own_quantity, (coalesce(a.quantity, 0) - coalesce(b.quantity, 0))::DOUBLE AS difference,
       coalesce(a.is_line, b.is_line)::BIGINT AS is_line
FROM a FULL JOIN b ON a.warehouse = b.warehouse AND a.item_id = b.item_id AND a.series = b.series
WHERE a.quantity - b.quantity <> 0 OR (a.quantity - b.quantity IS NULL AND coalesce(a.item, b.item) IS NOT NULL)
""")
def stock_recon(t):
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    flag = F.col("l_returnflag")
    series_a = F.when(flag == "R", F.lit("Без серии")).when(flag == "A", F.lit("партия б/н")).otherwise(F.lit("N"))
    customer = rows.where(F.col("l_linestatus") == "F").select(
        F.lit("ib").alias("base"), text("l_suppkey").alias("warehouse_ref"), F.col("p_name").alias("item"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("article"), F.col("p_brand").alias("article_alt"),
        F.col("p_brand").alias("code"), text("l_partkey").alias("item_id"), series_a.alias("series"), F.lit("pc").alias("unit"),
        F.col("l_quantity").cast(QUANTITY).alias("quantity"))
    nation = text("s_nationkey")
    links = t.supplier.select(
        text("s_suppkey").alias("customer_ref"),
        F.when(F.col("s_nationkey") == 3, F.lit("-")).otherwise(F.concat(F.lit("W"), nation)).alias("warehouse"),
        F.concat(F.lit("B"), (F.col("s_nationkey") < 10).cast("int").cast("string")).alias("own_base"))
    series_b = F.when(flag == "A", F.lit("Без Номера")).otherwise(F.lit("N от 01.01.2020"))
    written = F.concat(F.lit("1 "), F.lpad((F.col("l_quantity") + 234).cast("int").cast("string"), 3, "0"), F.lit(",00"))
    own = rows.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).where(F.col("l_linestatus") == "O").select(
        F.concat(F.lit("W"), nation).alias("warehouse"), F.when(flag == "R", F.lit("Брак")).otherwise(F.lit("Основное")).alias("room"),
        F.col("p_name").alias("item"), F.col("p_type").alias("article"), F.col("p_brand").alias("code"),
        text("l_partkey").alias("item_id"), series_b.alias("series"), F.lit("pc").alias("unit"), written.alias("quantity"))
    equipment = t.part.where(F.col("p_type") == "LARGE").select(text("p_partkey").alias("item_id"), F.lit(True).alias("is_line"))
    return stock.stock_reconciliation(customer, links, own, equipment, ["Основное"])
