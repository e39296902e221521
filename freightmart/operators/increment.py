"""Change detection against rows stored earlier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed_rows(current: DataFrame, stored: DataFrame, fingerprint: Mapping[str, Column]) -> DataFrame:
    """Rows of ``current`` whose fingerprint is not among the stored ones; NULLs are equal.

    A hot fingerprint is reduced to one row on the stored side before the join,
    and the row side of an anti join can be split.
    """
    marked = current.select("*", F.struct(*[e.alias(n) for n, e in fingerprint.items()]).alias("__mark"))
    known = stored.select(F.struct(*[e.alias(n) for n, e in fingerprint.items()]).alias("__mark")).distinct()
    return marked.join(known, "__mark", "left_anti").drop("__mark")
