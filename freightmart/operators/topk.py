"""First row per key, ties kept, and first/last values per key.

Filters on ``row_number`` and ``rank`` are turned by Catalyst into a
WindowGroupLimit that runs before the shuffle, so a hot key sends only its
best rows from every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key; ``order`` must be total for a repeatable result."""
    return best_rows(df, keys, order, 1).drop(RANK)


def best_rows(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key, numbered in ``RANK``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) <= n)


def first_with_ties(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """All rows that share the first place of their key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.rank().over(window)).where(F.col(RANK) == 1).drop(RANK)
