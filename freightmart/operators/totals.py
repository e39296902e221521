"""Group totals repeated on every row, without a window.

A window would bring all rows of a key into one task. Here the totals are
aggregated (partial sums before the shuffle) and joined back; the row side is
the left side, which adaptive execution splits when a key is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import few_rows


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def attach_totals(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column], nullable: bool = True, few: bool = False) -> DataFrame:
    """Add the aggregates ``totals`` of each key group to every row of the group.

    NULL keys are a group; with ``nullable=False`` their rows get NULL totals. The join compares null-safely, which Spark deals out by other expressions than the aggregate: both of its sides are
    plain shuffles, and only those can be split when a key is hot. ``few`` is for keys of few values, such as codes: the totals
    are counted, and the rows are not dealt out by them if there are few indeed.
    """
    grouped = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in totals.items()])
    grouped = grouped if nullable else grouped.dropna(subset=list(keys))
    renamed = grouped.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *totals)
    renamed = few_rows(renamed) if few else renamed
    pairs = [(k, f"__k_{k}") for k in keys]
    return df.join(renamed, null_safe(df, renamed, pairs), "left").drop(*[b for _, b in pairs])


def attach_many_totals(df: DataFrame, groups: Sequence[tuple[Sequence[str], Mapping[str, Column]]]) -> DataFrame:
    """Totals over several groupings, all taken from the columns of ``df`` itself; NULL keys are a group.

    The rows are computed once and kept. Every grouping aggregates the kept rows, so the plan grows with the number of
    groupings, where one ``attach_totals`` after the other doubles it each time. From three groupings on only the keys and
    the totals are moved for each of them, under a number of each row, and the whole rows once, to meet all their totals.
    """
    numbered = len(groups) > 2
    base = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()) if numbered else df)
    rows = base.select("__row", *dict.fromkeys(k for keys, _ in groups for k in keys)) if numbered else base
    for n, (keys, totals) in enumerate(groups):
        grouped = base.groupBy(*keys).agg(*[expr.alias(name) for name, expr in totals.items()])
        renamed = grouped.select(*[F.col(k).alias(f"__k{n}_{k}") for k in keys], *totals)
        pairs = [(k, f"__k{n}_{k}") for k in keys]
        rows = rows.join(renamed, null_safe(rows, renamed, pairs), "left").drop(*[b for _, b in pairs])
    if numbered:
        found = cut_lineage(rows.select("__row", *[name for _, totals in groups for name in totals]))
        rows = base.join(found, "__row").drop("__row")
    return rows
