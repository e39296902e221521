"""Warehouse service level: orders, their issue orders and scans, and working minutes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..functions.semantics import acronym, has_ref, live, shift_hours
from ..operators.joins import lookup
from ..operators.sla import sla_verdict, working_minutes
from ..operators.stringagg import list_values
from .warehouses import sla_kind

COLUMNS = [
    "order", "number", "ordered_on", "ordered_at", "issue", "issue_number", "issued_at", "shipped_at", "attached_at",
    "issue_status", "warehouse", "warehouse_kind", "branch", "order_weekday", "shipped_weekday", "schedule",
    "work_minutes", "verdict", "extensions", "sent", "shipment_number", "order_status", "upload_status", "expense_kind",
]


def issue_facts(issues: DataFrame, links: DataFrame, files: DataFrame, sent: DataFrame, since: str, shipped_status: str) -> DataFrame:
    """Shipped issue orders with the scans of the shipments they belong to.

    ``issues``: ref, number, issued_at, shipped_at, status, order, deleted,
    posted. ``links``: issue, shipment. ``files``: ref, owner, extension,
    created_at, signed. ``sent``: file, is_sent. A signed scan counts as sent.
    """
    start = F.lit(since).cast("timestamp_ntz")
    wanted = live(issues).where((F.col("issued_at") >= start) & (F.col("status") == shipped_status))
    scans = lookup(files, sent, "ref", "file", {"is_sent": "is_sent"}).select(
        F.col("owner").alias("shipment"), "extension", "created_at",
        (F.coalesce("is_sent", F.lit(False)) | F.coalesce("signed", F.lit(False))).alias("counts"),
    )
    seen = wanted.select(F.col("ref").alias("issue")).join(links, "issue").join(scans, "shipment")
    facts = seen.groupBy("issue").agg(F.max("counts").alias("sent"), F.max("created_at").alias("attached_at"))
    texts = list_values(seen, ["issue"], "extension", ",", "extensions")
    return (
        wanted.select(F.col("ref").alias("issue"), F.col("number").alias("issue_number"), "issued_at", "shipped_at",
                      F.col("status").alias("issue_status_ref"), "order")
        .join(facts, "issue", "left").join(texts, "issue", "left")
        .withColumn("sent", F.when(F.col("sent"), F.lit(fixed.YES)).otherwise(F.lit(fixed.NO)))
    )


def order_service_level(
    orders: DataFrame, facts: DataFrame, shipments: DataFrame, warehouses: DataFrame, statuses: DataFrame,
    expense_kind: Column, upload_status: Column, as_of: datetime,
) -> DataFrame:
    """One order kind with working minutes and verdict, on the warehouse's own clock.

    ``orders``: ref, number, placed_at, cleared_at, warehouse, status,
    deleted. The clock starts at the later of placing and clearing.
    ``shipments``: order, shipment_number. ``warehouses``: ref, name, usage,
    branch, hours, schedule.
    """
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    rows = orders.where(F.col("deleted") == F.lit(False))
    rows = lookup(rows, warehouses, "warehouse", "ref", {
        "name": "warehouse_name", "usage": "usage", "branch": "branch_name", "hours": "hours", "schedule": "schedule"})
    rows = rows.where(F.col("usage").isNotNull()).withColumnRenamed("ref", "__order").withColumnRenamed("number", "order_number")
    rows = rows.join(facts.withColumnRenamed("order", "__order"), "__order", "left")
    rows = lookup(rows, statuses, "issue_status_ref", "ref", {"name": "issue_status"})
    rows = rows.join(shipments.withColumnRenamed("order", "__order"), "__order", "left")
    hours = F.col("hours")
    rows = rows.withColumns({
        "__start": shift_hours(F.greatest("placed_at", "cleared_at"), hours),
        "__end": shift_hours(F.coalesce("attached_at", now), hours),
    })
    rows = working_minutes(rows, "__start", "__end", now, shift_hours(now, hours))
    shipped = shift_hours("shipped_at", hours)
    return rows.select(
        F.col("__order").alias("order"), F.col("order_number").alias("number"),
        shift_hours("placed_at", hours).cast("date").alias("ordered_on"), shift_hours("placed_at", hours).alias("ordered_at"),
        "issue", "issue_number", shift_hours("issued_at", hours).alias("issued_at"), shipped.alias("shipped_at"),
        F.col("__end").alias("attached_at"), "issue_status", F.col("warehouse_name").alias("warehouse"),
        sla_kind(F.col("warehouse_name"), F.col("usage")).alias("warehouse_kind"), acronym("branch_name").alias("branch"),
        "order_weekday", F.extract(F.lit("DAYOFWEEK_ISO"), shipped).alias("shipped_weekday"), "schedule", "work_minutes",
        sla_verdict(F.col("issue_status"), F.col("in_schedule_minutes")).alias("verdict"), "extensions", "sent",
        "shipment_number", F.col("status").alias("order_status"), upload_status.alias("upload_status"),
        expense_kind.alias("expense_kind"),
    ).select(*COLUMNS)


def own_upload_status(code: Column) -> Column:
    # Upload codes of own-storage orders
    return (
        F.when(code.isin(0, 5), F.lit("Отменено в базе Локотех")).when(code.isin(1, 2), F.lit("В Работе"))
        .when(code == 3, F.lit("Ошибка выгрузки в Локотех")).when(code == 4, F.lit("Без ошибок"))
    )


def customer_upload_status(status: Column) -> Column:
    # Fulfilment texts of 4PL orders
    return (
        F.when(status.isin("Комплектация отгружена", "Комплектации отгружена"), F.lit("Без ошибок"))
        .when(status.isin("Комплектация готова к отгрузке", "Комплектация сформирована"), F.lit("В Работе"))
        .when(status.isin("С ошибками при формировании комплектации", "С ошибками при подготовке комплектации к отгрузке"),
              F.lit("Ошибка выгрузки в Локотех"))
        .otherwise(F.lit("Статус не определен"))
    )


def service_level(own: DataFrame, customer: DataFrame) -> DataFrame:
    """Both order kinds in one list, each distinct row once."""
    return own.unionByName(customer).distinct()


def shipments_of_orders(shipments: DataFrame) -> DataFrame:
    """``shipments``: order, number, deleted; those that belong to an order."""
    kept = shipments.where((F.col("deleted") == F.lit(False)) & has_ref("order"))
    return kept.select("order", F.col("number").alias("shipment_number"))
