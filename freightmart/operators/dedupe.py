"""Duplicate rows: rows equal in everything but their update time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_newest(df: DataFrame, stamp: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct content, with its newest ``stamp``; a NULL stamp counts as the newest.

    ``keys`` defaults to all other columns: then a plain aggregate is enough
    and copies collapse before the shuffle. With a narrower natural key the
    whole newest row is kept.
    """
    others = [c for c in df.columns if c != stamp]
    if keys is None:
        newest = F.when(F.max(F.col(stamp).isNull()), F.lit(None)).otherwise(F.max(stamp))
        return df.groupBy(*others).agg(newest.alias(stamp)).select(*df.columns)
    rest = [c for c in others if c not in keys]
    best = F.max(F.struct(F.col(stamp).isNull().alias("__unknown"), F.col(stamp), *rest)).alias("__best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns]
    )


def duplicate_counts(df: DataFrame, stamp: str | None, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: all rows, distinct rows ignoring ``stamp``, and the surplus."""
    content = list(keys) if keys is not None else [c for c in df.columns if c != stamp]
    return (
        df.groupBy(*content)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_all"), F.count(F.lit(1)).alias("rows_distinct"))
        .withColumn("rows_removed", F.col("rows_all") - F.col("rows_distinct"))
    )


def dedupe_tables(
    tables: Mapping[str, DataFrame], stamp: str, as_of: datetime, keys: Mapping[str, Sequence[str]] | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Cleaned tables, and a log of the tables that held duplicates.

    The caller leaves out tables protected by a key of their own.
    """
    keys = keys or {}
    cleaned, log = {}, None
    for name, df in tables.items():
        cleaned[name] = keep_newest(df, stamp, keys.get(name))
        line = duplicate_counts(df, stamp, keys.get(name)).select(
            F.lit(name).alias("table_name"), "rows_all", "rows_distinct", "rows_removed",
            F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("logged_at"),
        )
        log = line if log is None else log.unionByName(line)
    return cleaned, log.where(F.col("rows_removed") > 0)
