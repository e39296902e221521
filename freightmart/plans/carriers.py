"""Carrier rating: bids and transports per day, monthly totals, trailing horizons."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..functions.semantics import age_months, latest, month_of
from ..operators.horizon import trailing_totals
from ..operators.totals import attach_totals
from ..session import cut_lineage

MEASURES = [
    "requests", "won", "cancelled", "went", "cancelled_by_carrier", "complex_routes",
    "from_far_east", "own_transport", "transport_price",
]
HORIZONS = {"185": 6, "1y": 12, "2y": 24}


def carriers(branches: DataFrame, users: DataFrame) -> DataFrame:
    """Carriers by tax id with their latest moderation status.

    ``branches``: tax_id, org, name, created_at, modified_at, moderation.
    ``users``: org, type.
    """
    moderated = branches.groupBy("tax_id").agg(
        latest("moderation", F.coalesce("created_at", "modified_at"), "moderation").alias("moderation")
    )
    carrying = users.where(F.col("type") == fixed.CARRIER_CANCELLER).select("org").distinct()
    first_seen = F.coalesce("created_at", F.lit("2019-07-15 09:00:00").cast("timestamp_ntz"))
    return (
        branches.join(carrying, "org", "left_semi")
        .groupBy("tax_id")
        .agg(F.max("name").alias("carrier_name"), F.min(first_seen).alias("created_at"))
        .join(moderated, "tax_id", "left")
    )


def transport_versions(
    transports: DataFrame, vehicles: DataFrame, carrier_reasons: DataFrame, branches: DataFrame, complex_routes: DataFrame
) -> DataFrame:
    """Every version of a transport; price, flags and dates only on the current one.

    ``transports``: number, price, created_at, updated_at, carrier, status,
    truck, cancel_reason, negotiation, first_driver, version (unique within
    a number).
    ``vehicles``: ref, right_to_use. ``carrier_reasons``: ref.
    ``branches``: org, tax_id. ``complex_routes``: negotiation.
    """
    stamp = F.coalesce("updated_at", "created_at")
    own = vehicles.where(F.col("right_to_use") == fixed.OWN_VEHICLE).select(F.col("ref").alias("truck"), F.lit(1).alias("own"))
    blamed = carrier_reasons.select(F.col("ref").alias("cancel_reason"), F.lit(1).alias("blamed")).distinct()
    tax = branches.select(F.col("org").alias("carrier"), "tax_id").distinct()
    routed = complex_routes.select("negotiation", F.col("negotiation").alias("complex_route")).distinct()
    # the current version is an aggregate joined back null-safely: a number with many versions can be split
    marked = attach_totals(transports, ["number"], {"__current": latest("version", stamp, "version")})
    current = F.col("version").eqNullSafe(F.col("__current"))
    # versions are told apart here, so that the joins do not carry their names
    marked = marked.select(
        "number", "carrier", "truck", "cancel_reason", "negotiation", "first_driver", current.alias("is_current"),
        F.when(current, F.col("price")).alias("final_price"),
        F.when(current, F.when(F.col("status") == "CANCELED", 1).otherwise(0)).alias("cancel_sign"))
    rows = (
        marked.join(own, "truck", "left").join(blamed, "cancel_reason", "left")
        .join(tax, "carrier", "left").join(routed, "negotiation", "left")
    )
    current = F.col("is_current")
    return rows.select(
        "number", "carrier", "tax_id", "negotiation", "first_driver", "is_current", "final_price",
        F.when(current, F.coalesce("own", F.lit(0))).alias("own_sign"), "cancel_sign",
        F.coalesce("blamed", F.lit(0)).alias("blamed_sign"),
        F.when(current, F.col("complex_route")).alias("complex_route"),
    )


def bids_with_transports(negotiations: DataFrame, bids: DataFrame, branches: DataFrame, versions: DataFrame, test_driver: str) -> DataFrame:
    """Bidders of a negotiation with the transports they carried out.

    With a bidder the transport must be the bidder's; a negotiation without
    bids takes every transport of its number. Two equality joins with disjoint
    inputs replace the OR condition. ``negotiations``: ref, number.
    ``bids``: negotiation, carrier.
    """
    tax = branches.select(F.col("org").alias("carrier"), F.col("tax_id").alias("bid_tax_id")).distinct()
    offers = (
        negotiations.where(F.col("number").isNotNull()).select(F.col("ref").alias("negotiation_ref"), "number")
        .join(bids.select(F.col("negotiation").alias("negotiation_ref"), "carrier"), "negotiation_ref", "left")
        .join(tax, "carrier", "left")
        .select("number", "bid_tax_id", F.col("carrier").alias("bid_carrier")).distinct()
    )
    # both joins read the same offers and versions, which are worked out once and kept
    offers = cut_lineage(offers)
    moved = cut_lineage(versions.where(F.col("first_driver") != test_driver))
    named = offers.where(F.col("bid_carrier").isNotNull()).join(
        moved.withColumn("bid_carrier", F.col("carrier")), ["number", "bid_carrier"]
    )
    open_ = offers.where(F.col("bid_carrier").isNull()).join(moved, "number")
    columns = ["number", "bid_tax_id", "bid_carrier", *[c for c in versions.columns if c != "number"]]
    both = named.select(*columns).unionByName(open_.select(*columns))
    return both.select(
        "number", F.coalesce("bid_tax_id", "tax_id").alias("tax_id"), F.coalesce("bid_carrier", "carrier").alias("carrier"),
        "final_price", "own_sign", "cancel_sign", "blamed_sign",
        F.when(F.col("is_current"), F.col("carrier")).alias("winner"), "negotiation", "complex_route",
    )


def carrier_days(
    cargos: DataFrame, orders: DataFrame, app_orders: DataFrame, endpoints: DataFrame, order_negotiations: DataFrame, offers: DataFrame
) -> DataFrame:
    """Conditional counts per carrier, day, negotiation and status.

    ``cargos``: number, order, origin. ``orders``: ref, created_at, status.
    ``app_orders``: order, originator. ``endpoints``: ref, region.
    ``order_negotiations``: order, negotiation. ``offers`` from
    ``bids_with_transports``.
    """
    in_app = app_orders.where(F.col("originator") == fixed.DRIVER_APP).select("order", F.lit(1).alias("in_app")).distinct()
    far = endpoints.where(F.col("region").isin(*fixed.FAR_EAST_REGIONS)).select(F.col("ref").alias("origin"), F.lit(1).alias("far"))
    rows = (
        cargos.withColumnRenamed("number", "cargo_number")
        .join(order_negotiations, "order")
        .join(orders.select(F.col("ref").alias("order"), "created_at", "status"), "order", "left")
        .join(in_app, "order", "left").join(far, "origin", "left")
        .join(offers, "negotiation", "left")
    )
    won = F.col("carrier") == F.col("winner")
    lost = F.col("status").isin(*fixed.LOST_STATUSES)
    kept = won & ~lost & (F.col("cancel_sign") == 0)

    def count_if(condition, value="cargo_number"):
        return F.count(F.when(condition, F.col(value)))

    return rows.groupBy(
        "tax_id", F.col("created_at").cast("date").alias("day"), "number", "cancel_sign", "status", "carrier", "winner"
    ).agg(
        F.count("cargo_number").alias("requests"),
        count_if(won).alias("won"),
        count_if(won & (lost | (F.col("cancel_sign") == 1))).alias("cancelled"),
        count_if(F.col("blamed_sign") == 1).alias("cancelled_by_carrier"),
        count_if(kept, "complex_route").alias("complex_routes"),
        F.max(F.coalesce("in_app", F.lit(0))).alias("mobile_application"),
        count_if(kept & F.col("far").isNotNull(), "origin").alias("from_far_east"),
        count_if(kept & (F.col("own_sign") == 1), "number").alias("own_transport"),
        F.sum(F.when(kept & F.col("number").isNotNull(), F.col("final_price")).otherwise(0)).alias("transport_price"),
    )


def carrier_rating(carrier_list: DataFrame, days: DataFrame, as_of: date) -> DataFrame:
    """Monthly carrier totals with the sums of the 6, 12 and 24 months before.

    ``days`` has tax_id, day, the measures without ``went``, and
    mobile_application. "Went" is won minus cancelled. Cooperation is the
    months between the first and last kept win, less the months idle since,
    never below 0.
    """
    zero = [c for c in [*MEASURES, "mobile_application"] if c != "went"]
    rows = carrier_list.join(days, "tax_id").withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})
    rows = rows.withColumn("went", F.when(F.col("won") == 0, 0).otherwise(F.col("won") - F.col("cancelled")))
    kept_day = F.when((F.col("won") > 0) & (F.col("cancelled_by_carrier") == 0), F.col("day"))
    rows = rows.withColumn("month", month_of("day")).withColumn("working_start", F.col("created_at").cast("date"))

    paid = F.when(F.col("went") > 0, F.col("transport_price")).otherwise(0)
    # the day rows are met once: months are few, and everything else is taken from them
    monthly = cut_lineage(rows.groupBy("carrier_name", "tax_id", "working_start", "month").agg(
        *[F.sum(m).alias(m) for m in MEASURES], F.max("mobile_application").alias("mobile_application"),
        F.sum(paid).alias("__paid"), F.min(kept_day).alias("__first"), F.max(kept_day).alias("__last"),
    ))
    # the horizons add up unconditional prices, as the day rows do
    trailing = trailing_totals(monthly, "tax_id", "month", MEASURES, HORIZONS)
    monthly = attach_totals(monthly, ["carrier_name"], {"first_win": F.min("__first"), "last_win": F.max("__last")})
    monthly = monthly.select(
        "carrier_name", "tax_id", "working_start", "first_win", "last_win", "month", *[m for m in MEASURES if m != "transport_price"],
        "mobile_application", F.col("__paid").alias("transport_price"))
    worked = age_months("last_win", "first_win")
    idle = age_months(F.lit(as_of.isoformat()).cast("date"), F.col("last_win"))
    months = worked - idle
    return (
        monthly.join(trailing, ["tax_id", "month"], "left")
        .withColumn("cooperation_months", F.when(months < 0, 0).otherwise(months))
    )
