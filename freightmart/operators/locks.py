"""Who waits for whom, from a snapshot table of lock-like rows.

A row waits when it is not granted; any other session on the same object is in
its way. Listing every pair grows with the square of a busy object, so each
waiting row gets the number of sessions in its way and the first and last of
them, which grows with the snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import prefixed
from .totals import attach_totals, null_safe


def blocked_sessions(locks: DataFrame, session: str, granted: str, object_keys: Sequence[str]) -> DataFrame:
    """Waiting rows with a summary of the other sessions on the same object; NULL keys are equal."""
    keys = list(object_keys)
    # one row per object and session: the rest of the work no longer depends on repeats
    sessions = cut_lineage(locks.groupBy(*keys, session).agg(F.count(F.lit(1)).alias("own_rows")))
    # the second smallest and largest replace the waiting session itself; totals are joined back so that a busy object can be split
    sessions = attach_totals(sessions, keys, {
        "sessions": F.count(F.lit(1)), "rows": F.sum("own_rows"), "first": F.min(session), "last": F.max(session)})
    sessions = attach_totals(sessions, keys, {
        "second": F.min(F.when(F.col(session) != F.col("first"), F.col(session))),
        "next_to_last": F.max(F.when(F.col(session) != F.col("last"), F.col(session))),
    })
    waiting = locks.where(F.col(granted) == F.lit(False))
    others = prefixed(sessions, "__s_")
    on = null_safe(waiting, others, [(k, f"__s_{k}") for k in [*keys, session]])
    joined = waiting.join(others, on).select(
        *[waiting[c] for c in locks.columns],
        *[F.col(f"__s_{c}").alias(c) for c in ("own_rows", "sessions", "rows", "first", "last", "second", "next_to_last")])
    return joined.where(F.col("sessions") > 1).select(
        *locks.columns,
        (F.col("rows") - F.col("own_rows")).alias("blocking_rows"),
        (F.col("sessions") - 1).alias("blocking_sessions"),
        F.when(F.col("first") == F.col(session), F.col("second")).otherwise(F.col("first")).alias("first_blocker"),
        F.when(F.col("last") == F.col(session), F.col("next_to_last")).otherwise(F.col("last")).alias("last_blocker"),
    )
