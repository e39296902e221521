"""Request money and carrier reports on the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..plans import carriers, finance
from .registry import AS_OF, money, query, text
from .stock import QUANTITY

END = date.fromisoformat(AS_OF)

# Orders play requests; each line of an order is a route of the request.
STATUSES = {"F": "Доставлен", "O": "В пути", "P": "Новая"}
ROUTES_SQL = """
SELECT o_orderkey::VARCHAR AS request_number, o_orderdate AS request_date,
       CASE WHEN l_linenumber < 7 THEN concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) END AS route_number,
       CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS route_date,
       c_name AS payer, c_mktsegment AS payer_group, CASE WHEN l_returnflag = 'A' THEN 'Автотранспорт' ELSE 'Авиа' END AS delivery_type,
       CASE l_linestatus WHEN 'F' THEN 'STANDARD' ELSE CASE WHEN l_linenumber > 3 THEN 'COMPLEX' ELSE 'CIRCULAR' END END AS route_type,
       p_type AS trailer_type, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'xPlanet' ELSE 'УПП' END AS created_in,
       CASE WHEN l_tax < 0.02 THEN 0 WHEN l_tax < 0.06 THEN 1 END AS is_consolidation,
       CASE WHEN l_discount > 0.01 THEN l_extendedprice::DECIMAL(18,2) END AS customer_price,
       (l_extendedprice::DECIMAL(18,2) - 100)::DECIMAL(18,2) AS carrier_price, CASE WHEN l_tax > 0.01 THEN (l_quantity * 100)::DECIMAL(18,2) END AS request_price,
       l_linenumber AS class1, 1 AS class2, 0 AS class3, 0 AS class4, 0 AS class5, 0 AS class6, 0 AS class7, 0 AS class8, 0 AS class9,
       (l_returnflag = 'N')::INT AS fast, (l_returnflag = 'A')::INT AS side, (l_linestatus = 'O')::INT AS top,
       l_quantity AS distance, (l_quantity * 40)::DECIMAL(18,2) AS weight, l_linestatus AS status,
       CASE WHEN l_linenumber = 6 THEN NULL WHEN o_orderstatus = 'F' THEN 'Доставлен' WHEN o_orderstatus = 'O' THEN 'В пути' ELSE 'Новая' END AS final_status,
       CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 3 DAY WHEN l_returnflag = 'N' THEN TIMESTAMP '1970-01-01' END AS unload_fact,
       CASE WHEN l_returnflag = 'A' THEN l_shipdate + INTERVAL 10 DAY END AS unload_plan,
       CASE WHEN l_discount > 0.05 THEN l_shipdate - INTERVAL 1 DAY END AS load_fact,
       CASE WHEN l_tax > 0.02 THEN o_orderdate + INTERVAL 5 DAY END AS load_plan,
       l_shipdate AS updated_at, 2 * l_quantity AS row_weight
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
"""


def route_rows(t):
    # lines and orders meet by the number of the request, by which the reports group and join: those move no rows again
    heads = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).withColumn("request_number", text("o_orderkey"))
    lines = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).withColumn("request_number", text("l_orderkey"))
    rows = lines.join(heads, "request_number")
    flag, line, tax = F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_tax")
    shipped = F.col("l_shipdate")
    days = lambda n: F.expr(f"INTERVAL {n} DAYS")
    final = F.when(line == 6, F.lit(None)).when(F.col("o_orderstatus") == "F", F.lit(STATUSES["F"])).when(
        F.col("o_orderstatus") == "O", F.lit(STATUSES["O"])).otherwise(F.lit(STATUSES["P"]))
    return rows.select(
        "request_number", F.col("o_orderdate").alias("request_date"),
        F.when(line < 7, F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("route_number"),
        F.when(flag != "R", shipped).alias("route_date"), F.col("c_name").alias("payer"), F.col("c_mktsegment").alias("payer_group"),
        F.when(flag == "A", F.lit("Автотранспорт")).otherwise(F.lit("Авиа")).alias("delivery_type"),
        F.when(F.col("l_linestatus") == "F", F.lit("STANDARD")).when(line > 3, F.lit("COMPLEX")).otherwise(F.lit("CIRCULAR")).alias("route_type"),
        F.col("p_type").alias("trailer_type"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("xPlanet")).otherwise(F.lit("УПП")).alias("created_in"),
        F.when(tax < 0.02, 0).when(tax < 0.06, 1).alias("is_consolidation"),
        F.when(F.col("l_discount") > 0.01, money("l_extendedprice")).alias("customer_price"),
        (money("l_extendedprice") - 100).cast("decimal(18,2)").alias("carrier_price"),
        F.when(tax > 0.01, (F.col("l_quantity") * 100).cast(QUANTITY)).alias("request_price"),
        line.alias("class1"), F.lit(1).alias("class2"), *[F.lit(0).alias(f"class{i}") for i in range(3, 10)],
        (flag == "N").cast("int").alias("fast"), (flag == "A").cast("int").alias("side"), (F.col("l_linestatus") == "O").cast("int").alias("top"),
        F.col("l_quantity").alias("distance"), (F.col("l_quantity") * 40).cast(QUANTITY).alias("weight"), F.col("l_linestatus").alias("status"),
        final.alias("final_status"),
        F.when(F.col("l_linestatus") == "F", shipped + days(3)).when(flag == "N", F.lit("1970-01-01").cast("timestamp_ntz")).alias("unload_fact"),
        F.when(flag == "A", shipped + days(10)).alias("unload_plan"), F.when(F.col("l_discount") > 0.05, shipped - days(1)).alias("load_fact"),
        F.when(tax > 0.02, F.col("o_orderdate") + days(5)).alias("load_plan"), shipped.alias("updated_at"),
    )


@query(f"""
SELECT request_number, strftime(request_date, '%Y-%m-%d %H:%M:%S') AS request_date, route_number, (is_consolidation = 1)::BIGINT AS fourpl,
       final_status, (route_number IS NOT NULL)::BIGINT AS has_route
FROM ({ROUTES_SQL})
""")
def route_copy(t):
    rows = route_rows(t).withColumn("fourpl", F.col("is_consolidation"))
    return finance.route_copy(rows, ["request_number", "request_date", "route_number", "fourpl", "final_status"])


# The floor date of real dates is 2011, so the test dates move forward by ten years.
ROLL_SQL = f"""
d AS (
  SELECT * REPLACE (request_date + INTERVAL 10 YEAR AS request_date, route_date + INTERVAL 10 YEAR AS route_date,
                    unload_fact + INTERVAL 10 YEAR AS unload_fact, unload_plan + INTERVAL 10 YEAR AS unload_plan,
                    load_fact + INTERVAL 10 YEAR AS load_fact, load_plan + INTERVAL 10 YEAR AS load_plan, updated_at + INTERVAL 10 YEAR AS updated_at)
  FROM ({ROUTES_SQL})),
e AS (
  SELECT *, (CASE WHEN CASE WHEN unload_fact < request_date THEN NULL ELSE unload_fact END > TIMESTAMP '2011-01-01' THEN unload_fact
                  WHEN unload_plan > TIMESTAMP '2011-01-01' THEN unload_plan
                  ELSE CASE WHEN load_fact > TIMESTAMP '2011-01-01' THEN load_fact + INTERVAL 5 DAY ELSE load_plan + INTERVAL 5 DAY END END)::DATE AS date_d
  FROM d WHERE {{where}}),
c AS (
  SELECT *, string_agg(route_number, ', ' ORDER BY route_number) OVER p AS routes, count(route_number) OVER p AS count_routes,
         first_value(payer) OVER newest AS client, first_value(payer_group) OVER newest AS client_group,
         first_value(delivery_type) OVER (PARTITION BY request_number ORDER BY route_date ASC NULLS LAST, route_number ASC NULLS FIRST, delivery_type ASC NULLS FIRST) AS delivery_type1,
         CASE WHEN count(route_number) OVER p > 1 THEN first_value(delivery_type) OVER (PARTITION BY request_number ORDER BY route_date DESC NULLS FIRST, route_number DESC NULLS LAST, delivery_type DESC NULLS LAST) END AS delivery_type2,
         first_value(route_type) OVER (PARTITION BY request_number ORDER BY route_date ASC NULLS LAST, route_number ASC NULLS FIRST, route_type ASC NULLS FIRST) AS route_type1, first_value(route_type) OVER (PARTITION BY request_number ORDER BY route_date DESC NULLS FIRST, route_number DESC NULLS LAST, route_type DESC NULLS LAST) AS route_type2,
         first_value(trailer_type) OVER (PARTITION BY request_number ORDER BY route_date ASC NULLS LAST, route_number ASC NULLS FIRST, trailer_type ASC NULLS FIRST) AS trailer_type1, first_value(created_in) OVER (PARTITION BY request_number ORDER BY route_date ASC NULLS LAST, route_number ASC NULLS FIRST, created_in ASC NULLS FIRST) AS created,
         first_value(CASE WHEN is_consolidation = 0 THEN 'Прямой рейс' ELSE 'Через склад' END) OVER (PARTITION BY request_number ORDER BY route_date ASC NULLS LAST, route_number ASC NULLS FIRST, CASE WHEN is_consolidation = 0 THEN 'Прямой рейс' ELSE 'Через склад' END ASC NULLS FIRST) AS first_trip,
         max(coalesce(is_consolidation, 0)) OVER p AS any_consolidation,
         sum(customer_price) OVER p AS price, sum(carrier_price) OVER p AS cost,
         sum(class1 + class2 + class3 + class4 + class5 + class6 + class7 + class8 + class9) OVER p AS danger, sum(fast) OVER p AS fast_sum,
         sum(side + top) OVER p AS top_side, sum(distance) OVER p AS distance_sum,
         first_value(CASE WHEN weight > 1000 THEN weight / 1000 ELSE weight END) OVER (PARTITION BY request_number ORDER BY route_date ASC NULLS LAST, route_number ASC NULLS FIRST, CASE WHEN weight > 1000 THEN weight / 1000 ELSE weight END ASC NULLS FIRST) AS first_weight,
         first_value(status) OVER (PARTITION BY request_number ORDER BY route_date DESC NULLS FIRST, route_number DESC NULLS LAST, status DESC NULLS LAST) AS last_status,
         coalesce(final_status IN ('Доставлен', 'Отгружен', 'В работе', 'В пути', 'Водитель назначен', 'Доставлено', 'Выполнено', 'Выполнена'), false) AS status_fin,
         coalesce(final_status IN ('Доставлен', 'Доставлено', 'Выполнено', 'Выполнена'), false) AS settled,
         sum(coalesce(request_price, 0)) OVER p AS total,
         row_number() OVER (PARTITION BY request_number ORDER BY date_d DESC NULLS FIRST, route_date DESC NULLS LAST, route_number DESC NULLS LAST, updated_at DESC) AS rn,
         row_number() OVER (PARTITION BY request_number ORDER BY route_date DESC NULLS LAST, route_number DESC NULLS LAST) AS top_rn
  FROM e
  WINDOW p AS (PARTITION BY request_number),
         newest AS (PARTITION BY request_number ORDER BY {{client}} DESC NULLS FIRST, route_number DESC NULLS LAST),
         top_row AS (PARTITION BY request_number ORDER BY route_date DESC NULLS LAST, route_number DESC NULLS LAST))
"""
# an absent route number sorts below every other one in both directions
SHOWN_SQL = """
request_number, request_date::DATE::VARCHAR AS request_date, routes, count_routes, client, client_group, delivery_type1, delivery_type2,
route_type1, route_type2, trailer_type1, created AS created_in, {trip} AS transportation_type, price::DOUBLE AS price, cost::DOUBLE AS cost,
danger::BIGINT AS danger, fast_sum::BIGINT AS fast, top_side::BIGINT AS top_side, {profit}::DOUBLE AS profit, distance_sum AS distance,
round(first_weight::DOUBLE, 6) AS weight, last_status AS status, status_fin::BIGINT AS status_fin, date_d::VARCHAR AS date_d
"""


def later(rows):
    dates = ["request_date", "route_date", "unload_fact", "unload_plan", "load_fact", "load_plan", "updated_at"]
    return rows.withColumns({c: F.col(c) + F.expr("INTERVAL 10 YEARS") for c in dates})


def rounded(df):
    return df.withColumn("weight", F.round(F.col("weight").cast("double"), 6))


@query(f"""
WITH {ROLL_SQL.format(where="true", client="coalesce(route_date, TIMESTAMP '2001-01-01')")}
SELECT {SHOWN_SQL.format(trip="CASE WHEN any_consolidation = 0 THEN 'Прямой рейс' ELSE 'Через склад' END", profit="(total - cost)")},
       settled::BIGINT AS settled, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at,
       CASE WHEN top_rn = 1 THEN total ELSE 0 END::DOUBLE AS price_all
FROM c WHERE rn = 1 AND request_number IN (SELECT request_number FROM d WHERE route_date >= TIMESTAMP '2009-01-01')
""")
def plan_fact(t):
    return rounded(finance.plan_fact(later(route_rows(t)), since="2009-01-01"))


INC_WHERE = "request_date > TIMESTAMP '2011-01-01'"
PERIOD_SQL = """
SELECT * FROM c WHERE rn = 1 AND date_d >= DATE '2011-01-01' AND date_d < DATE '2011-12-01' AND settled
"""


@query(f"""
WITH {ROLL_SQL.format(where=INC_WHERE, client="route_date")},
rows AS ({PERIOD_SQL}),
stored AS (SELECT request_number, ceil(CASE WHEN client_group = 'BUILDING' THEN price + 1 ELSE price END) AS price
           FROM rows WHERE client_group <> 'MACHINERY'),
inc AS (SELECT request_number, ceil(price) AS price FROM rows EXCEPT SELECT * FROM stored)
SELECT {SHOWN_SQL.format(trip="first_trip", profit="(price - cost)")}, '2011-11-01' AS date_d_month
FROM rows WHERE EXISTS (SELECT 1 FROM inc WHERE inc.request_number = rows.request_number AND inc.price IS NOT DISTINCT FROM ceil(rows.price))
""")
def period_close_increment(t):
    rows, as_of = later(route_rows(t)), date(2011, 12, 15)
    before = finance.period_rows(rows, as_of).where(F.col("client_group") != "MACHINERY").withColumn(
        "price", F.when(F.col("client_group") == "BUILDING", F.col("price") + 1).otherwise(F.col("price")))
    return rounded(finance.period_increment(rows, before, as_of))


@query(f"""
WITH r AS (SELECT *, weight / 100 AS rl_weight, weight / 80 AS rl_weight_max, weight + 5 AS weight_by_dimension, row_weight AS max_dimension,
                  'W' || status AS warehouse, carrier_price AS start_price, updated_at AS status_date FROM ({ROUTES_SQL})),
z AS (SELECT DISTINCT request_number FROM r WHERE route_date >= TIMESTAMP '1997-01-01' AND final_status IN ('В пути', 'Отгружен') AND route_number IS NOT NULL),
q AS (SELECT o_orderkey::VARCHAR AS number, o_orderdate + (length(o_orderpriority) * 3 - 20) * INTERVAL 1 SECOND AS created_at,
             o_totalprice > 400000 AS deleted FROM orders),
j AS (
  SELECT r.* FROM r LEFT JOIN q ON number = request_number AND abs(epoch(q.created_at) - epoch(request_date)) < 20
  WHERE request_number IN (SELECT request_number FROM z) AND (deleted IS NULL OR NOT deleted)),
w AS (
  SELECT *, row_number() OVER (PARTITION BY request_number ORDER BY load_plan DESC NULLS LAST, route_date DESC NULLS LAST, {{rest}}) AS rn,
         max(status_date) OVER p AS last_status_date, max(route_date::DATE) OVER p AS last_route_date,
         sum(customer_price) OVER p AS price_request, sum(carrier_price) OVER p AS cost_request,
         sum(coalesce(request_price, 0)) OVER p AS asked, sum(customer_price) OVER m AS price_route, sum(carrier_price) OVER m AS cost_route,
         CASE WHEN max_dimension > 15 AND rl_weight < 20 THEN 20 ELSE rl_weight END AS tons,
         coalesce(CASE WHEN route_type = 'CIRCULAR' OR rl_weight_max > rl_weight THEN rl_weight_max ELSE rl_weight END, 0) AS route_tons,
         coalesce(CASE WHEN weight_by_dimension > weight THEN weight_by_dimension ELSE weight END, 0) AS request_tons
  FROM j WINDOW p AS (PARTITION BY request_number), m AS (PARTITION BY route_number))
SELECT request_number, route_number, strftime(route_date, '%Y-%m-%d %H:%M:%S') AS route_date,
       strftime(CASE WHEN unload_fact < request_date THEN NULL ELSE unload_fact END, '%Y-%m-%d %H:%M:%S') AS unload_fact,
       strftime(last_status_date, '%Y-%m-%d %H:%M:%S') AS last_status_date, last_route_date::VARCHAR AS last_route_date,
       CASE WHEN delivery_type <> 'Автотранспорт' THEN 'Нет данных'
            WHEN tons / (CASE route_type WHEN 'STANDARD' THEN 1 WHEN 'CIRCULAR' THEN 2 ELSE 3 END) <= 1.5 THEN '1,5 т'
            WHEN tons / (CASE route_type WHEN 'STANDARD' THEN 1 WHEN 'CIRCULAR' THEN 2 ELSE 3 END) <= 3.5 THEN '3,5 т'
            WHEN tons / (CASE route_type WHEN 'STANDARD' THEN 1 WHEN 'CIRCULAR' THEN 2 ELSE 3 END) <= 5 THEN '5 т'
            WHEN tons / (CASE route_type WHEN 'STANDARD' THEN 1 WHEN 'CIRCULAR' THEN 2 ELSE 3 END) <= 10 THEN '10 т'
            WHEN tons / (CASE route_type WHEN 'STANDARD' THEN 1 WHEN 'CIRCULAR' THEN 2 ELSE 3 END) <= 24 THEN '20 т' ELSE 'Прочие' END AS trailer_class,
       CASE WHEN route_tons <= 1.5 THEN '1.5 т.' WHEN route_tons <= 3.5 THEN '3 т.' WHEN route_tons <= 5.5 THEN '5 т.'
            WHEN route_tons <= 10.5 THEN '10 т.' WHEN route_tons <= 20.5 THEN '20 т.' ELSE '20+ т.' END AS weight_category,
       CASE WHEN request_tons <= 1.5 THEN '1.5 т.' WHEN request_tons <= 3.5 THEN '3 т.' WHEN request_tons <= 5.5 THEN '5 т.'
            WHEN request_tons <= 10.5 THEN '10 т.' WHEN request_tons <= 20.5 THEN '20 т.' ELSE '20+ т.' END AS request_weight_category,
       CASE WHEN coalesce(is_consolidation, 0) = 0 THEN 'Прямой рейс' ELSE 'Через склад' END AS transportation_type,
       CASE WHEN is_consolidation = 0 THEN 'Нет' ELSE warehouse END AS warehouse,
       coalesce(customer_price, 0)::DOUBLE AS price, coalesce(carrier_price, 0)::DOUBLE AS cost, coalesce(request_price, 0)::DOUBLE AS request_price,
       price_route::DOUBLE AS price_route, cost_route::DOUBLE AS cost_route, price_request::DOUBLE AS price_request, cost_request::DOUBLE AS cost_request,
       coalesce(start_price, 0)::DOUBLE AS start_price, (class1 + class2)::BIGINT AS danger,
       (coalesce(customer_price, 0) - coalesce(carrier_price, 0))::DOUBLE AS profit,
       CASE WHEN rn = 1 THEN CASE WHEN created_in = 'xPlanet' THEN coalesce(request_price, 0) ELSE asked END ELSE 0 END::DOUBLE AS price_all
FROM w
""".replace(
    "{rest}", "request_date, route_number, payer, payer_group, delivery_type, route_type, trailer_type, created_in, is_consolidation, customer_price"))
def request_cost(t):
    weight = F.col("weight")
    rows = route_rows(t).withColumns({
        "rl_weight": weight / 100, "rl_weight_max": weight / 80, "weight_by_dimension": weight + 5, "max_dimension": F.col("distance") * 2,
        "warehouse": F.concat(F.lit("W"), "status"), "start_price": F.col("carrier_price"), "status_date": F.col("updated_at")})
    requests = t.orders.select(
        text("o_orderkey").alias("number"), (F.col("o_totalprice") > 400000).alias("deleted"),
        F.expr("o_orderdate + make_dt_interval(0, 0, 0, length(o_orderpriority) * 3 - 20)").alias("created_at"))
    result = finance.request_cost(rows, requests, since="1997-01-01")
    return result.select(
        "request_number", "route_number", "route_date", "unload_fact", "last_status_date", "last_route_date", "trailer_class",
        "weight_category", "request_weight_category", "transportation_type", "warehouse", "price", "cost", "request_price", "price_route",
        "cost_route", "price_request", "cost_request", "start_price", "danger", "profit", "price_all")


# --- carriers: suppliers carry; an order is a negotiation its suppliers bid on -----------

def carrier_tables(t):
    key, supplier = text("l_orderkey"), text("l_suppkey")
    branches = t.supplier.select(
        F.concat(F.lit("T"), text("s_nationkey")).alias("tax_id"), text("s_suppkey").alias("org"), F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 3000, F.lit("1994-03-05 00:00:00").cast("timestamp_ntz")).alias("created_at"),
        F.lit("1994-01-01").cast("timestamp_ntz").alias("modified_at"), F.concat(F.lit("m"), text("s_suppkey")).alias("moderation"))
    users = t.supplier.select(text("s_suppkey").alias("org"), F.when(F.col("s_nationkey") < 20, F.lit("CARRIER")).otherwise(F.lit("X")).alias("type"))
    cargos = t.orders.select(F.concat(F.lit("C"), text("o_orderkey")).alias("number"), text("o_orderkey").alias("order"),
                             text("o_custkey").alias("origin"))
    orders = t.orders.select(
        text("o_orderkey").alias("ref"), F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "P", F.lit("CANCELED")).when(F.col("o_orderpriority") == "5-LOW", F.lit("EXPIRED"))
        .otherwise(F.lit("SHIPPED")).alias("status"))
    app = t.lineitem.select(key.alias("order"), F.when(F.col("l_tax") > 0.07, F.lit("driver-service")).otherwise(F.lit("web")).alias("originator"))
    endpoints = t.customer.select(text("c_custkey").alias("ref"), text("c_nationkey").alias("region"))
    links = t.orders.select(text("o_orderkey").alias("order"), F.concat(F.lit("G"), text("o_orderkey")).alias("negotiation"))
    negotiations = t.orders.select(F.concat(F.lit("G"), text("o_orderkey")).alias("ref"), F.concat(F.lit("N"), text("o_orderkey")).alias("number"))
    bids = t.lineitem.where(F.col("l_linestatus") == "F").select(F.concat(F.lit("G"), key).alias("negotiation"), supplier.alias("carrier"))
    transports = t.lineitem.select(
        F.concat(F.lit("N"), key).alias("number"), money("l_extendedprice").alias("price"), F.col("l_shipdate").alias("created_at"),
        F.when(F.col("l_returnflag") == "A", F.col("l_shipdate") + F.expr("INTERVAL 40 DAYS")).alias("updated_at"), supplier.alias("carrier"),
        F.when(F.col("l_returnflag") == "R", F.lit("CANCELED")).otherwise(F.lit("SHIPPED")).alias("status"), text("l_partkey").alias("truck"),
        F.col("l_linenumber").cast("string").alias("cancel_reason"), F.concat(F.lit("G"), key).alias("negotiation"),
        F.when(F.col("l_discount") == 0.0, F.lit("test")).otherwise(F.lit("driver")).alias("first_driver"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", money("l_extendedprice").cast("string")).alias("version"))
    vehicles = t.part.select(text("p_partkey").alias("ref"), F.when(F.col("p_type") == "PROMO", F.lit("OWN")).otherwise(F.lit("RENT")).alias("right_to_use"))
    reasons = t.lineitem.where(F.col("l_linenumber") <= 2).select(F.col("l_linenumber").cast("string").alias("ref")).distinct()
    complex_routes = t.orders.where(F.col("o_orderpriority") == "3-MEDIUM").select(F.concat(F.lit("G"), text("o_orderkey")).alias("negotiation"))
    return locals()


DAYS_SQL = """
tv AS (
  SELECT 'N' || l_orderkey AS number, l_suppkey AS carrier, 'T' || s_nationkey AS tax_id, 'G' || l_orderkey AS negotiation,
         CASE WHEN l_discount = 0 THEN 'test' ELSE 'driver' END AS first_driver,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'A' THEN l_shipdate + INTERVAL 40 DAY ELSE l_shipdate END DESC,
                            concat_ws('-', l_linenumber, l_partkey, l_suppkey, l_extendedprice::DECIMAL(18,2)) DESC) AS rn,
         l_extendedprice::DECIMAL(18,2) AS price, (p_type = 'PROMO')::INT AS own, (l_returnflag = 'R')::INT AS cancel, (l_linenumber <= 2)::INT AS blamed,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'G' || l_orderkey END AS complex_route
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey),
tra AS (
  SELECT number, carrier, tax_id, negotiation, first_driver, rn, blamed, CASE WHEN rn = 1 THEN price END AS final_price,
         CASE WHEN rn = 1 THEN own END AS own_sign, CASE WHEN rn = 1 THEN cancel END AS cancel_sign, CASE WHEN rn = 1 THEN complex_route END AS complex_route
  FROM tv),
ng AS (
  SELECT DISTINCT 'N' || o_orderkey AS number, l_suppkey AS bid_carrier, CASE WHEN l_suppkey IS NOT NULL THEN 'T' || s_nationkey END AS bid_tax
  FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_linestatus = 'F') ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey),
neg AS (
  SELECT ng.number, coalesce(bid_tax, tax_id) AS tax_id, coalesce(bid_carrier, carrier) AS carrier, final_price, own_sign, cancel_sign, blamed,
         CASE WHEN rn = 1 THEN carrier END AS winner, negotiation, complex_route
  FROM ng JOIN tra ON (tra.number = ng.number AND bid_carrier IS NOT NULL AND carrier = bid_carrier) OR (tra.number = ng.number AND bid_carrier IS NULL)
  WHERE first_driver <> 'test'),
base AS (
  SELECT 'C' || o_orderkey AS cargo, o_orderdate::DATE AS day, CASE WHEN o_orderstatus = 'P' THEN 'CANCELED' WHEN o_orderpriority = '5-LOW' THEN 'EXPIRED' ELSE 'SHIPPED' END AS status,
         o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.07) AS in_app, c_nationkey IN (1, 3, 14, 19, 24) AS far, c_custkey, neg.*
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN neg ON neg.negotiation = 'G' || o_orderkey),
days AS (
  SELECT tax_id, day, number, cancel_sign, status, carrier, winner, count(cargo) AS requests, count(CASE WHEN carrier = winner THEN 1 END) AS won,
         count(CASE WHEN carrier = winner AND (status IN ('CANCELED', 'EXPIRED') OR cancel_sign = 1) THEN 1 END) AS cancelled,
         count(CASE WHEN blamed = 1 THEN 1 END) AS cancelled_by_carrier,
         count(CASE WHEN complex_route IS NOT NULL AND carrier = winner AND status NOT IN ('CANCELED', 'EXPIRED') AND cancel_sign = 0 THEN 1 END) AS complex_routes,
         max(in_app::INT) AS mobile_application,
         count(CASE WHEN far AND carrier = winner AND status NOT IN ('CANCELED', 'EXPIRED') AND cancel_sign = 0 THEN 1 END) AS from_far_east,
         count(CASE WHEN own_sign = 1 AND status NOT IN ('CANCELED', 'EXPIRED') AND cancel_sign = 0 AND carrier = winner THEN number END) AS own_transport,
         sum(CASE WHEN number IS NOT NULL AND status NOT IN ('CANCELED', 'EXPIRED') AND cancel_sign = 0 AND carrier = winner THEN final_price ELSE 0 END) AS transport_price
  FROM base GROUP BY ALL)
"""


def day_rows(t):
    c = carrier_tables(t)
    versions = carriers.transport_versions(c["transports"], c["vehicles"], c["reasons"], c["branches"], c["complex_routes"])
    offers = carriers.bids_with_transports(c["negotiations"], c["bids"], c["branches"], versions, "test")
    return carriers.carrier_days(c["cargos"], c["orders"], c["app"], c["endpoints"], c["links"], offers), c


@query(f"""
WITH {DAYS_SQL}
SELECT tax_id, day::VARCHAR AS day, number, cancel_sign::BIGINT AS cancel_sign, status, carrier::VARCHAR AS carrier, winner::VARCHAR AS winner, requests, won,
       cancelled, cancelled_by_carrier, complex_routes, mobile_application::BIGINT AS mobile_application, from_far_east, own_transport,
       transport_price::DOUBLE AS transport_price
FROM days
""")
def carrier_days(t):
    return day_rows(t)[0]


_HORIZON_SQL = "\n".join(f"""LEFT JOIN LATERAL (
  SELECT {", ".join(f"sum({m}) AS {m}_{s}" for m in carriers.MEASURES)} FROM car b
  WHERE b.tax_id = m.tax_id AND b.month >= m.month - INTERVAL {n} MONTH AND b.month < m.month) h{n} ON true""" for s, n in carriers.HORIZONS.items())


@query(f"""
WITH {DAYS_SQL},
carriers AS (
  SELECT 'T' || s_nationkey AS tax_id, max(s_name) AS carrier_name,
         min(CASE WHEN s_acctbal > 3000 THEN TIMESTAMP '1994-03-05' ELSE TIMESTAMP '2019-07-15 09:00:00' END)::DATE AS working_start
  FROM supplier WHERE s_nationkey < 20 GROUP BY 1),
joined AS (
  SELECT carriers.*, days.* EXCLUDE (tax_id), date_trunc('month', day)::DATE AS month, CASE WHEN won = 0 THEN 0 ELSE won - cancelled END AS went
  FROM carriers JOIN days USING (tax_id)),
car AS (
  SELECT *, min(CASE WHEN won > 0 AND cancelled_by_carrier = 0 THEN day END) OVER (PARTITION BY carrier_name) AS first_win,
         max(CASE WHEN won > 0 AND cancelled_by_carrier = 0 THEN day END) OVER (PARTITION BY carrier_name) AS last_win
  FROM joined),
m AS (
  SELECT carrier_name, tax_id, working_start, first_win, last_win, month, sum(requests) AS requests, sum(won) AS won, sum(cancelled) AS cancelled, sum(went) AS went,
         sum(cancelled_by_carrier) AS cancelled_by_carrier, sum(complex_routes) AS complex_routes, max(mobile_application) AS mobile_application,
         sum(from_far_east) AS from_far_east, sum(own_transport) AS own_transport, sum(CASE WHEN went > 0 THEN transport_price ELSE 0 END) AS transport_price,
         date_part('year', age(last_win::TIMESTAMP, first_win::TIMESTAMP)) * 12 + date_part('month', age(last_win::TIMESTAMP, first_win::TIMESTAMP))
         - date_part('year', age(TIMESTAMP '{AS_OF}', last_win::TIMESTAMP)) * 12 - date_part('month', age(TIMESTAMP '{AS_OF}', last_win::TIMESTAMP)) AS coop
  FROM car GROUP BY carrier_name, tax_id, working_start, first_win, last_win, month)
SELECT tax_id, carrier_name, working_start::VARCHAR AS working_start, first_win::VARCHAR AS first_win, last_win::VARCHAR AS last_win,
       greatest(coop, 0)::BIGINT AS cooperation_months, month::VARCHAR AS month, mobile_application::BIGINT AS mobile_application,
       {", ".join(f"{c}::{'DOUBLE' if c == 'transport_price' else 'BIGINT'} AS {c}" for c in carriers.MEASURES)},
       {", ".join(f"coalesce({c}_{s}, 0)::{'DOUBLE' if c == 'transport_price' else 'BIGINT'} AS {c}_{s}" for s in carriers.HORIZONS for c in carriers.MEASURES)}
FROM m {_HORIZON_SQL}
""")
def carrier_rating(t):
    days, c = day_rows(t)
    listed = carriers.carriers(c["branches"], c["users"])
    return carriers.carrier_rating(listed, days, END)
