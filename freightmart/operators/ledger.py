"""Month-end balances from a movement ledger."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.semantics import month_of


def signed(direction: Column, amount: Column) -> Column:
    """Direction 0 is a receipt, anything else an issue."""
    return F.when(direction == 0, amount).otherwise(-amount)


def months(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per calendar month between two dates, with its last day."""
    first = F.trunc(F.lit(start.isoformat()).cast("date"), "month")
    last = F.lit(end.isoformat()).cast("date")
    listed = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return listed.withColumn("month_end", F.last_day("month"))


def calendar_months(calendar: DataFrame, day: str, start: date) -> DataFrame:
    """Distinct months of a calendar table from a start date on."""
    return (
        calendar.where(F.col(day) >= F.lit(start.isoformat()).cast("date"))
        .select(month_of(day).alias("month"))
        .distinct()
        .withColumn("month_end", F.last_day("month"))
    )


def monthly_balance(
    ledger: DataFrame, keys: Sequence[str], period: str, amount: Column, calendar: DataFrame, as_of: date,
) -> DataFrame:
    """Non-zero balance of every key at each month end.

    ``amount`` is the signed quantity. A balance holds from its month up to the
    month before the key's next movement, the last one through ``as_of``'s
    month. The window runs over one row per key and month, so its size is
    bounded by the calendar whatever the number of movements.
    """
    net = (
        ledger.groupBy(*keys, month_of(period).alias("moved"))
        .agg(F.sum(amount).alias("net"))
    )
    by_month = Window.partitionBy(*keys).orderBy("moved")
    after_last = F.add_months(F.trunc(F.lit(as_of.isoformat()).cast("date"), "month"), 1)
    balances = net.select(
        *keys,
        "moved",
        F.sum("net").over(by_month).alias("balance"),
        F.lead("moved", 1).over(by_month).alias("__next"),
    ).withColumn("until", F.coalesce("__next", after_last))
    held = (
        F.when(F.col("until") > F.col("moved"),
               F.sequence(F.col("moved"), F.add_months("until", -1), F.expr("INTERVAL 1 MONTH")))
        .when(F.col("until") == F.col("moved"), F.array("moved"))
    )
    spread = balances.where(F.col("balance") != 0).select(*keys, "balance", F.explode(held).alias("month"))
    # the calendar has at most one row per month of the date type's range
    return spread.join(F.broadcast(calendar), "month").select("month", "month_end", *keys, "balance")
