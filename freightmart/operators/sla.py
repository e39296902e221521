"""Working minutes between an order and its completion, on a warehouse schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..functions.semantics import round_int


def schedules(spark: SparkSession) -> DataFrame:
    """The fixed list of schedules: opening and closing minute of the day, minutes off per day."""
    return spark.createDataFrame(
        fixed.SCHEDULES, "schedule string, open_minute int, close_minute int, off_minutes int"
    )


def minutes_between(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros.cast("decimal(24,0)") / F.lit(60_000_000)


def working_minutes(orders: DataFrame, start: str, end: str, now: Column, now_local: Column) -> DataFrame:
    """Add ``work_case``, ``work_minutes`` and ``order_weekday``.

    ``start`` is the moment the clock starts, ``end`` the completion (never
    NULL for the in-schedule cases), both in warehouse time. The time is
    counted from the opening when the order came before it, from the order
    itself within hours, and from the next opening after hours. Every day in
    between costs the schedule's minutes off; weekends are not taken out.
    Without a schedule case the time runs to ``now_local``.
    """
    known = F.broadcast(schedules(orders.sparkSession))  # fixed eight rows
    joined = orders.join(known, "schedule", "left")
    begin, finish = F.col(start), F.col(end)
    midnight = F.date_trunc("day", begin).cast("timestamp_ntz")
    minute = F.expr("INTERVAL 1 MINUTE")
    opening = midnight + F.col("open_minute") * minute
    closing = midnight + F.col("close_minute") * minute
    day_dif = F.coalesce(
        F.datediff(finish.cast("date"), begin.cast("date")), F.datediff(now.cast("date"), begin.cast("date"))
    )
    next_day = F.expr("INTERVAL 1 DAY")
    case = (
        F.when(begin.between(midnight, opening), F.lit("before"))
        .when(begin.between(opening, closing), F.lit("within"))
        .when(begin.between(closing, midnight + next_day), F.lit("after"))
    )
    clocked = (
        joined.withColumn("work_case", case).withColumn("__days", day_dif)
        .withColumn("__open", opening)
        .withColumn("order_weekday", F.extract(F.lit("DAYOFWEEK_ISO"), begin))
    )
    off = F.col("off_minutes")
    counted = (
        F.when(F.col("work_case") == "before", minutes_between(finish, F.col("__open")) - off * F.col("__days"))
        .when(F.col("work_case") == "within", minutes_between(finish, begin) - off * F.col("__days"))
        .when(F.col("work_case") == "after",
              minutes_between(finish, F.col("__open") + next_day) - off * (F.col("__days") - 1))
    )
    running = minutes_between(now_local, begin) - off * F.col("__days")
    return (
        clocked.withColumn("in_schedule_minutes", round_int(counted))
        .withColumn("work_minutes", F.coalesce(F.col("in_schedule_minutes"), round_int(running)))
        .drop("__days", "__open")
    )


def sla_verdict(status: Column, minutes: Column) -> Column:
    """In work until shipped; then in time when the working minutes are within the limit."""
    return (
        F.when(status.isNull() | (status != fixed.SLA_SHIPPED), F.lit(fixed.SLA_IN_WORK))
        .when(minutes.between(0, fixed.SLA_MINUTES), F.lit(fixed.SLA_IN_TIME))
        .otherwise(F.lit(fixed.SLA_LATE))
    )
