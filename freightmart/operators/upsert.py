"""Reference table kept up to date from an import."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_missing(
    stored: DataFrame, incoming: DataFrame, key: str, empty: Column, fill: Sequence[str]
) -> DataFrame:
    """Take ``fill`` columns from ``incoming`` where ``empty`` holds on the stored row and the key is known there.

    ``incoming`` has one row per key. A row the import does not know stays as it is.
    """
    side = incoming.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in fill])
    joined = stored.withColumn("__empty", empty).join(side, stored[key] == side["__key"], "left")
    take = F.col("__key").isNotNull() & F.col("__empty")
    return joined.select(
        *[F.when(take, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in fill else F.col(c)
          for c in stored.columns]
    )


def add_missing(stored: DataFrame, incoming: DataFrame, key: str, values: Mapping[str, Column]) -> DataFrame:
    """Append import rows whose key is not stored yet; columns not in ``values`` become NULL."""
    fresh = incoming.join(stored.select(key), key, "left_anti")
    appended = fresh.select(
        *[values.get(c, F.lit(None)).cast(stored.schema[c].dataType).alias(c) for c in stored.columns]
    )
    return stored.unionByName(appended)
