"""Waybills per route and request with the state of their electronic and paper documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..functions.ladder import yes_no
from ..functions.semantics import descending, has_ref, live, repair_year, route_key
from ..operators.joins import few_rows, lookup
from ..operators.topk import first_per_key

# Yes / no texts in small letters and the sales document text
YES, NO = "да", "нет"


def latest_status(register: DataFrame, statuses: DataFrame, out: str, must_have_name: bool = False) -> DataFrame:
    """Latest status name per document. ``register``: document, status, period; ``statuses``: ref, name."""
    # all documents share a few statuses: they are not dealt out by them
    names = few_rows(statuses.select(F.col("ref").alias("status"), F.col("name").alias(out)))
    named = register.join(names, "status", "inner" if must_have_name else "left")
    return first_per_key(named, ["document"], [descending("period"), descending(out)]).select("document", out)


def route_base(routes: DataFrame, route_lines: DataFrame, requests: DataFrame, statuses: DataFrame, since: str) -> DataFrame:
    """Routes with their live requests, without those the customer cancelled.

    ``routes``: ref, number, day, status, unloaded_at, deleted, posted.
    ``route_lines``: route, request, load_place, unload_place, loaded_at,
    line_unloaded_at. ``requests``: ref, number, deleted, posted.
    """
    recent = live(routes).where(F.col("day") > F.lit(since).cast("timestamp_ntz"))
    named = lookup(recent, few_rows(statuses.select("ref", "name")), "status", "ref", {"name": "route_status"})
    named = named.where(F.col("route_status") != fixed.CANCELLED_BY_CUSTOMER)
    kept = named.select(F.col("ref").alias("route"), F.col("number").alias("route_number"), "day", "route_status", "unloaded_at")
    asked = live(requests).select(F.col("ref").alias("request"), F.col("number").alias("request_number"))
    return kept.join(route_lines, "route").join(asked, "request").withColumn("key", route_key("route_number", "request_number"))


def _document_key(df: DataFrame, routes: DataFrame, route_lines: DataFrame, requests: DataFrame) -> DataFrame:
    """Route and request numbers of a document that names a route and a request; the pair must exist as a line."""
    rows = lookup(df, routes, "route", "ref", {"number": "route_number"})
    pairs = route_lines.select("route", "request", F.col("request").alias("line_request")).distinct()
    rows = rows.join(pairs, ["route", "request"], "left")
    rows = lookup(rows, requests, "line_request", "ref", {"number": "request_number"})
    return rows.withColumn("key", route_key("route_number", "request_number"))


def incoming_packages(packages: DataFrame, routes: DataFrame, route_lines: DataFrame, requests: DataFrame) -> DataFrame:
    """Best package per route and request number: valid first, then the newest.

    ``packages``: package, route, request, received_at, is_valid, processed,
    error. Packages whose numbers are unknown share one group, because the
    grouping text is NULL when either number is; they are told apart only by
    the first of them.
    """
    rows = _document_key(packages, routes, route_lines, requests).withColumn(
        "__group", F.concat("route_number", F.lit("/"), "request_number")
    )
    best = first_per_key(rows, ["__group"], [descending("is_valid"), descending("received_at"), descending("package")])
    return best.select("key", "package", "received_at", "is_valid", "processed", "error")


def sales_documents(
    sales: DataFrame, wanted: DataFrame, routes: DataFrame, route_lines: DataFrame, requests: DataFrame,
    electronic: DataFrame, paper: DataFrame,
) -> DataFrame:
    """Sales documents of the wanted requests with their latest electronic and paper status.

    ``sales``: ref, number, day, route, request, amount. ``wanted``: request.
    ``electronic`` and ``paper`` from ``latest_status``.
    """
    kept = sales.join(wanted.select("request").distinct(), "request", "left_semi")
    rows = _document_key(kept, routes, route_lines, requests)
    rows = rows.join(electronic.withColumnRenamed("document", "ref"), "ref", "left")
    rows = rows.join(paper.withColumnRenamed("document", "ref"), "ref", "left")
    title = F.concat(F.lit("РТУ №"), F.trim("number"), F.lit(" от "), F.date_format("day", "yyyy-MM-dd"))
    return rows.select("key", title.alias("sale"), F.col("day").alias("sale_day"), "amount", "electronic_status", "paper_status")


def waybill_status(base: DataFrame, packages: DataFrame, sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Route lines with an unloading place, their package, their sales document and calendar attributes.

    ``calendar``: date, year_month, year_week.
    """
    rows = base.where(F.col("unload_place") != "").withColumns({
        "date": F.col("day").cast("date"), "__key": F.trim("key"),
        "loaded_at": repair_year("loaded_at"), "line_unloaded_at": repair_year("line_unloaded_at"),
        "unloaded_at": repair_year("unloaded_at"),
    })
    rows = rows.join(calendar.select("date", "year_month", "year_week"), "date")
    pack = packages.withColumn("__key", F.trim("key")).withColumnRenamed("key", "package_key")
    sold = sales.withColumn("__key", F.trim("key")).withColumnRenamed("key", "sale_key")
    rows = rows.join(pack, "__key", "left").join(sold, "__key", "left").drop("__key")
    return rows.withColumns({
        "package_received": yes_no(F.col("package_key").isNotNull(), YES, NO),
        "package_processed": yes_no(F.col("processed") == F.lit(True), YES, NO),
        "is_valid": F.coalesce("is_valid", F.lit(False)),
    })


def electronic_documents(register: DataFrame, statuses: DataFrame) -> DataFrame:
    """Latest electronic status of documents that are set."""
    return latest_status(register.where(has_ref("document")), statuses, "electronic_status")
