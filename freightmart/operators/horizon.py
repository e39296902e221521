"""Totals over the months before the current one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import month_index


def trailing_totals(
    df: DataFrame, key: str, month: str, measures: Sequence[str], horizons: Mapping[str, int]
) -> DataFrame:
    """Per key and month, each measure summed over the given numbers of earlier months.

    Rows are first aggregated to one per key and month; the range window then
    sees at most one row per calendar month and counts gaps correctly. The
    current month is not included; a horizon without data gives 0.
    """
    monthly = df.groupBy(key, month).agg(*[F.sum(m).alias(m) for m in measures]).withColumn(
        "__index", month_index(month)
    )
    columns = [F.col(key), F.col(month)]
    for suffix, length in horizons.items():
        window = Window.partitionBy(key).orderBy("__index").rangeBetween(-length, -1)
        columns += [F.coalesce(F.sum(m).over(window), F.lit(0)).alias(f"{m}_{suffix}") for m in measures]
    return monthly.select(*columns)
