"""Request money reports: copy of route rows, period close, plan/fact, request cost."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..functions.semantics import earliest, effective_date, latest, weight_class
from ..operators.increment import changed_rows
from ..operators.joins import within_seconds
from ..operators.ordinal import number_rows
from ..operators.stringagg import list_values
from ..operators.totals import attach_many_totals

HAZARD_CLASSES = [f"class{i}" for i in range(1, 10)]


def route_copy(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Route rows for reporting: chosen columns, the 4PL mark as boolean, and whether a route exists."""
    names = columns or rows.columns
    shown = [F.col(c).cast("boolean").alias(c) if c == "fourpl" else F.col(c) for c in names]
    return rows.select(*shown, F.when(F.col("route_number").isNotNull(), 1).otherwise(0).alias("has_route"))


def _total(columns: list[str]) -> Column:
    total = F.col(columns[0])
    for name in columns[1:]:
        total = total + F.col(name)
    return total


def request_rollup(rows: DataFrame, null_route_date_first: bool = True) -> DataFrame:
    """One row per request: totals, first and last route values, and the row with the latest effective date.

    ``rows``: request_number, request_date, route_number, route_date, payer,
    payer_group, delivery_type, route_type, trailer_type, created_in,
    is_consolidation, customer_price, carrier_price, request_price,
    class1..class9, fast, side, top, distance, weight, status, final_status,
    unload_fact, unload_plan, load_fact, load_plan, updated_at. Columns a
    caller does not have may be NULL.

    Everything is one aggregation with partial combine; a request of any size
    stays one buffer. Ties are broken by route number. Values the business
    takes from "some row" come from the earliest route.
    """
    dated = rows.withColumn(
        "date_d", effective_date("unload_fact", "request_date", "unload_plan", "load_fact", "load_plan")
    )
    route_date = F.col("route_date")
    client_date = route_date if null_route_date_first else F.coalesce(
        route_date, F.lit("2001-01-01").cast("timestamp_ntz")
    )

    def last(name: str, by: Column = route_date) -> Column:
        return latest(name, by, "route_number")

    def first(name: str | Column) -> Column:
        return earliest(name, route_date, "route_number")

    tons = F.when(F.col("weight") > 1000, F.col("weight") / 1000).otherwise(F.col("weight"))
    trip = F.when(F.col("is_consolidation") == 0, F.lit(fixed.DIRECT_TRIP)).otherwise(F.lit(fixed.VIA_WAREHOUSE))
    shown = F.struct("request_date", "final_status", "date_d", "updated_at", "route_number", "route_date")
    rolled = dated.groupBy("request_number").agg(
        F.count("route_number").alias("count_routes"),
        last("payer", client_date).alias("client"),
        last("payer_group", client_date).alias("client_group"),
        first("delivery_type").alias("delivery_type1"),
        last("delivery_type").alias("__last_delivery"),
        first("route_type").alias("route_type1"),
        last("route_type").alias("route_type2"),
        first("trailer_type").alias("trailer_type1"),
        first("created_in").alias("created_in"),
        first(trip).alias("first_trip"),
        F.max(F.coalesce("is_consolidation", F.lit(0))).alias("any_consolidation"),
        F.sum("customer_price").alias("price"),
        F.sum("carrier_price").alias("cost"),
        F.sum(F.coalesce("request_price", F.lit(0))).cast("decimal(12,2)").alias("price_total"),
        F.sum(_total(HAZARD_CLASSES)).alias("danger"),
        F.sum("fast").alias("fast"),
        F.sum(F.col("side") + F.col("top")).alias("top_side"),
        F.sum("distance").alias("distance"),
        first(tons).alias("weight"),
        last("status").alias("status"),
        F.max(route_date).alias("last_route_date"),
        latest(shown, "date_d", route_date, "route_number", "updated_at").alias("__row"),
        latest(F.struct("route_number", "route_date"), route_date, "route_number", nulls_win=False).alias("__top"),
    )
    active = F.col("__row.final_status").isin(*fixed.FINAL_ACTIVE)
    done = F.col("__row.final_status").isin(*fixed.FINAL_DELIVERED)
    on_top = F.struct("__row.route_number", "__row.route_date").eqNullSafe(
        F.struct("__top.route_number", "__top.route_date")
    )
    routes = list_values(rows, ["request_number"], "route_number", ", ", "routes", distinct=False)
    flat = (
        rolled.withColumn("delivery_type2", F.when(F.col("count_routes") > 1, F.col("__last_delivery")))
        .withColumn("request_date", F.col("__row.request_date").cast("date"))
        .withColumn("date_d", F.col("__row.date_d"))
        .withColumn("final_status", F.col("__row.final_status"))
        .withColumn("updated_at", F.col("__row.updated_at"))
        .withColumn("status_fin", F.coalesce(active, F.lit(False)))
        .withColumn("settled", F.coalesce(done, F.lit(False)))
        .withColumn("price_all", F.when(on_top, F.col("price_total")).otherwise(0).cast("decimal(12,2)"))
        .drop("__row", "__top", "__last_delivery")
    )
    return flat.join(routes, "request_number", "left")


PERIOD_COLUMNS = [
    "request_number", "request_date", "routes", "count_routes", "client", "client_group", "delivery_type1",
    "delivery_type2", "route_type1", "route_type2", "trailer_type1", "created_in", "transportation_type",
    "price", "cost", "danger", "fast", "top_side", "profit", "distance", "weight", "status", "status_fin",
    "date_d", "date_d_month",
]


def period_rows(rows: DataFrame, as_of: date) -> DataFrame:
    """Delivered requests of the year up to the end of the month before ``as_of``."""
    this_month = F.trunc(F.lit(as_of.isoformat()).cast("date"), "month")
    year_start = F.trunc(F.add_months(this_month, -1), "year")
    rolled = request_rollup(rows.where(F.col("request_date") > year_start.cast("timestamp_ntz")))
    return (
        rolled.where((F.col("date_d") >= year_start) & (F.col("date_d") < this_month) & F.col("settled"))
        .withColumn("transportation_type", F.col("first_trip"))
        .withColumn("profit", F.col("price") - F.col("cost"))
        .withColumn("date_d_month", F.trunc("date_d", "month"))
        .select(*PERIOD_COLUMNS)
    )


def period_increment(rows: DataFrame, stored: DataFrame, as_of: date) -> DataFrame:
    """Rows to append when a month is closed: requests that are new or whose price changed.

    A change is a new pair of request and price rounded up, against stored rows
    of the same year. Every row, also a corrected older one, is stamped with
    the month being closed.
    """
    this_month = F.trunc(F.lit(as_of.isoformat()).cast("date"), "month")
    closed = F.add_months(this_month, -1)
    mark = {"request": F.col("request_number"), "price": F.ceil("price").cast("decimal(38,0)")}
    known = stored.where(F.col("date_d") >= F.trunc(closed, "year"))
    return changed_rows(period_rows(rows, as_of), known, mark).withColumn("date_d_month", closed)


def plan_fact(rows: DataFrame, since: str = "2020-01-01") -> DataFrame:
    """Management plan/fact: rollup of requests that have a route since the given date."""
    rolled = request_rollup(rows, null_route_date_first=False)
    # every row of a request is in its group, so the existence test is one maximum
    kept = rolled.where(F.col("last_route_date") >= F.lit(since).cast("timestamp_ntz"))
    trip = F.when(F.col("any_consolidation") == 0, F.lit(fixed.DIRECT_TRIP)).otherwise(F.lit(fixed.VIA_WAREHOUSE))
    return kept.withColumn("transportation_type", trip).withColumn(
        "profit", F.col("price_total") - F.col("cost")
    ).select(
        "request_number", "request_date", "routes", "count_routes", "client", "client_group", "delivery_type1",
        "delivery_type2", "route_type1", "route_type2", "trailer_type1", "created_in", "transportation_type",
        "price", "cost", "danger", "fast", "top_side", "profit", "distance", "weight", "status", "status_fin",
        "settled", "date_d", "updated_at", "price_all",
    )


def trailer_class(route_type: Column, delivery_type: Column, weight: Column, length: Column) -> Column:
    """Trailer class by weight per leg; only road deliveries have one. Over the top class: other."""
    tons = F.when((length > fixed.LONG_CARGO_M) & (weight < fixed.LONG_CARGO_MIN_T), fixed.LONG_CARGO_MIN_T).otherwise(weight)
    chain = F.when(delivery_type != fixed.DELIVERY_FIXED, F.lit(fixed.NO_DATA))
    for name, divisor in fixed.ROUTE_DIVISORS:
        chain = chain.when(route_type == name, weight_class(tons / divisor, fixed.TRAILER_CLASSES, fixed.OTHER))
    return chain.otherwise(F.lit(fixed.OTHER))


def route_weight(route_type: Column, weight: Column, weight_max: Column) -> Column:
    """Circular routes count their heaviest leg; others only when it is above the row's own weight."""
    return F.coalesce(F.when((route_type == "CIRCULAR") | (weight_max > weight), weight_max).otherwise(weight), F.lit(0))


def request_weight(weight: Column, by_dimension: Column) -> Column:
    return F.coalesce(F.when(by_dimension > weight, by_dimension).otherwise(weight), F.lit(0))


def request_cost(rows: DataFrame, requests: DataFrame, since: str = "2020-01-01") -> DataFrame:
    """Cost of requests per route row, with route and request totals and the price on one row.

    ``rows`` as for ``request_rollup`` plus rl_weight, rl_weight_max,
    weight_by_dimension, max_dimension, warehouse, start_price, status_date.
    ``requests``: number, created_at, deleted.
    """
    wanted = rows.where(
        (F.col("route_date") >= F.lit(since).cast("timestamp_ntz"))
        & F.col("final_status").isin(*fixed.COST_STATUSES) & F.col("route_number").isNotNull()
    ).select("request_number").distinct()
    kept = rows.join(wanted, "request_number", "left_semi")
    origin = requests.select(F.col("number").alias("__number"), F.col("created_at").alias("__created"),
                             F.col("deleted").alias("__deleted"))
    kept = within_seconds(kept, origin, [("request_number", "__number")], "request_date", "__created", 20)
    kept = kept.where(F.coalesce(F.col("__deleted"), F.lit(False)) == F.lit(False)).drop("__number", "__created", "__deleted")

    # newest plan first, then newest route; negative days sort descending with NULL last
    micros = lambda c: -F.unix_micros(F.col(c).cast("timestamp"))
    ordered = kept.withColumn("__plan", micros("load_plan")).withColumn("__route", micros("route_date"))
    numbered = number_rows(ordered, ["request_number"], ["__plan", "__route"], "__n").drop("__plan", "__route")
    price, cost, asked = F.col("customer_price"), F.col("carrier_price"), F.coalesce("request_price", F.lit(0))
    totals = attach_many_totals(numbered, [
        (["request_number"], {
            "last_status_date": F.max("status_date"), "last_route_date": F.max(F.col("route_date").cast("date")),
            "price_request": F.sum(price), "cost_request": F.sum(cost), "asked_request": F.sum(asked).cast("decimal(12,2)"),
        }),
        (["route_number"], {"price_route": F.sum(price), "cost_route": F.sum(cost)}),
    ])
    first_price = F.when(F.col("created_in") == fixed.PLATFORM_PLACE, asked.cast("decimal(12,2)")).otherwise(
        F.col("asked_request")
    )
    carried = F.coalesce("is_consolidation", F.lit(0)) == 0
    return totals.select(
        "route_date", "request_date", "load_plan", "unload_plan", "load_fact",
        F.when(~F.coalesce(F.col("unload_fact") < F.col("request_date"), F.lit(False)), F.col("unload_fact")).alias("unload_fact"),
        "last_status_date", "last_route_date", "route_number", "request_number",
        F.col("payer").alias("client"), F.col("payer_group").alias("client_group"), "delivery_type", "status",
        "final_status", "is_consolidation", "route_type", "trailer_type",
        trailer_class(F.col("route_type"), F.col("delivery_type"), F.col("rl_weight"), F.col("max_dimension")).alias("trailer_class"),
        weight_class(route_weight(F.col("route_type"), F.col("rl_weight"), F.col("rl_weight_max")),
                     fixed.WEIGHT_CATEGORIES, fixed.WEIGHT_CATEGORY_TOP).alias("weight_category"),
        weight_class(request_weight(F.col("weight"), F.col("weight_by_dimension")),
                     fixed.WEIGHT_CATEGORIES, fixed.WEIGHT_CATEGORY_TOP).alias("request_weight_category"),
        F.when(carried, F.lit(fixed.DIRECT_TRIP)).otherwise(F.lit(fixed.VIA_WAREHOUSE)).alias("transportation_type"),
        F.when(F.col("is_consolidation") == 0, F.lit(fixed.NO)).otherwise(F.col("warehouse")).alias("warehouse"),
        F.coalesce(price, F.lit(0)).alias("price"), F.coalesce(cost, F.lit(0)).alias("cost"), asked.alias("request_price"),
        "price_route", "cost_route", "price_request", "cost_request",
        F.coalesce("start_price", F.lit(0)).alias("start_price"),
        _total(HAZARD_CLASSES).alias("danger"), "fast", (F.col("side") + F.col("top")).alias("top_side"),
        (F.coalesce(price, F.lit(0)) - F.coalesce(cost, F.lit(0))).alias("profit"),
        "distance", "weight", "max_dimension",
        F.when(F.col("__n") == 1, first_price).otherwise(0).cast("decimal(12,2)").alias("price_all"),
    )
