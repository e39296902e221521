"""Stock reports: month-end balances, valued movements, two-system reconciliation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..functions.semantics import matches_any, to_quantity
from ..operators.joins import link_full_join, lookup, prefixed
from ..operators.ledger import monthly_balance, signed


def month_end_stock(ledger: DataFrame, warehouses: DataFrame, items: DataFrame, calendar: DataFrame, as_of: date) -> DataFrame:
    """Non-zero stock per warehouse name and item at each month end.

    ``ledger``: period, warehouse, item, direction (0 receipt), quantity.
    ``warehouses``: ref, name. ``items``: ref, code, article, name.
    ``calendar``: month, month_end.
    """
    known = ledger.where(F.col("warehouse").isNotNull())
    # one row per warehouse, item and month before the dictionaries are joined
    net = (
        known.withColumn("moved", F.trunc(F.col("period").cast("date"), "month"))
        .groupBy("warehouse", "item", "moved")
        .agg(F.sum(signed(F.col("direction"), F.col("quantity"))).alias("net"))
    )
    named = lookup(net, warehouses, "warehouse", "ref", {"name": "warehouse_name"})
    named = lookup(named, items, "item", "ref", {"code": "item_code", "article": "article", "name": "item_name"})
    keys = ["warehouse_name", "item_code", "article", "item", "item_name"]
    return monthly_balance(named, keys, "moved", F.col("net"), calendar, as_of)


def movement_value(
    ledger: DataFrame, operation_types: DataFrame, assignments: DataFrame, assignment_types: DataFrame,
    issue_orders: DataFrame, equipment: DataFrame, prices: DataFrame, warehouse_classes: DataFrame, year: int,
) -> DataFrame:
    """Movements of one year with their value at list price and warehouse attributes.

    ``ledger``: period, warehouse, item, assignment, registrar, type,
    direction, quantity. ``operation_types``: type, name. ``assignments``: ref,
    kind. ``assignment_types``: ref, name. ``issue_orders``: ref, comment.
    ``equipment``: ref, is_line. ``prices``: item, price.
    """
    start, end = f"{year}-01-01", f"{year + 1}-01-01"
    rows = ledger.where(
        (F.col("period") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("period") < F.lit(end).cast("timestamp_ntz"))
        & (F.col("type") != fixed.ASSIGNMENT_CORRECTION_TYPE)
    )
    rows = lookup(rows, operation_types, "type", "type", {"name": "operation"})
    rows = lookup(rows, assignments, "assignment", "ref", {"kind": "assignment_kind"})
    rows = lookup(rows, assignment_types, "assignment_kind", "ref", {"name": "assignment_name"})
    rows = lookup(rows, issue_orders, "registrar", "ref", {"comment": "comment"})
    rows = lookup(rows, equipment, "item", "ref", {"is_line": "is_line"})
    rows = lookup(rows, prices, "item", "item", {"price": "price"})
    rows = lookup(rows, warehouse_classes, "warehouse", "warehouse_ref", {
        "branch_short": "branch_short", "department": "department", "warehouse": "warehouse_name",
        "kind": "kind", "owner": "owner", "format": "format",
    })
    quantity = signed(F.col("direction"), F.col("quantity"))
    return rows.select(
        "branch_short", "department", F.col("warehouse_name").alias("warehouse"), "kind", "owner", "format",
        F.col("period").cast("date").alias("moved_on"),
        F.coalesce("is_line", F.lit(False)).alias("is_line"),
        F.coalesce("assignment_name", F.lit(fixed.FREE_STOCK)).alias("assignment"),
        "operation",
        F.when(F.col("comment").like(fixed.BUYOUT_PATTERN), F.lit(fixed.BUYOUT)).alias("buyout"),
        quantity.alias("quantity"),
        (quantity * F.col("price")).alias("amount"),
    )


def stock_reconciliation(
    customer_stock: DataFrame, warehouse_links: DataFrame, own_stock: DataFrame, equipment: DataFrame, rooms: list[str],
) -> DataFrame:
    """Customer stock against own stock per warehouse, item id and series; differences and one-sided rows.

    ``customer_stock``: base, warehouse_ref, item, article, article_alt, code,
    item_id, series, unit, quantity. ``warehouse_links``: customer_ref,
    warehouse, own_base. ``own_stock``: warehouse, room, item, article, code, item_id,
    series, unit, quantity (as text). ``equipment``: item_id, is_line.
    """
    series = F.col("series")
    # a linked warehouse without customer stock still gives one empty row
    left = warehouse_links.where(F.col("warehouse") != "-").join(
        customer_stock, F.col("warehouse_ref") == F.col("customer_ref"), "left"
    )
    left = lookup(left, equipment, "item_id", "item_id", {"is_line": "is_line"})
    left = (
        left.withColumn("article", F.coalesce("article", "article_alt"))
        .withColumn("series", F.when(matches_any(series, fixed.SERIES_NONE_LEFT) | (series == "%бн%"), F.lit(""))
                    .otherwise(F.coalesce(series, F.lit(""))))
        .withColumn("is_line", F.coalesce("is_line", F.lit(False)))
        .groupBy("base", "warehouse", "item", "article", "code", "item_id", "series", "unit", "is_line")
        .agg(F.sum("quantity").alias("quantity"))
    )
    # a warehouse served by several bases repeats its stock once per base
    known = warehouse_links.select("warehouse", F.col("own_base").alias("base")).distinct()
    right = own_stock.where(F.col("room").isin(*rooms)).join(known, "warehouse")
    right = lookup(right, equipment, "item_id", "item_id", {"is_line": "is_line"})
    right = (
        right.withColumn("series", F.when(matches_any(series, fixed.SERIES_NONE_RIGHT), F.lit(""))
                         .otherwise(F.coalesce(F.split_part(series, F.lit(fixed.SERIES_CUT), F.lit(1)), F.lit(""))))
        .withColumn("is_line", F.coalesce("is_line", F.lit(False)))
        .groupBy("base", "warehouse", "item", "article", "code", "item_id", "series", "unit", "is_line")
        .agg(F.sum(to_quantity("quantity")).alias("quantity"))
    )
    a, b = prefixed(left, "a_"), prefixed(right, "b_")
    both = link_full_join(b, a, [(f"b_{k}", f"a_{k}") for k in ("warehouse", "item_id", "series")])
    apart = F.col("a_quantity") - F.col("b_quantity")
    # the item test belongs to the one-sided branch only
    shown = both.where((apart != 0) | (apart.isNull() & F.coalesce("a_item", "b_item").isNotNull()))
    return shown.select(
        *[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in
          ("warehouse", "item", "article", "code", "item_id", "unit", "series")],
        F.coalesce("a_quantity", F.lit(0)).alias("customer_quantity"),
        F.coalesce("b_quantity", F.lit(0)).alias("own_quantity"),
        (F.coalesce("a_quantity", F.lit(0)) - F.coalesce("b_quantity", F.lit(0))).alias("difference"),
        F.coalesce("a_is_line", "b_is_line").alias("is_line"),
    )
