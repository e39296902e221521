"""Row numbers inside key groups that may be arbitrarily large.

The rows are dealt into sorted ranges by (key, order), with bounds that Spark
samples. Each range is numbered by itself, and the part of a key that lies in a
later range is moved by the key's rows in the ranges before. No task holds more
than its range, however hot a key or one value of its order is. Identical rows
are first collapsed into one row with a count and expanded again in chunks, so
a mass of copies does not fill one range either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, freed_shuffles
from .totals import null_safe

CHUNK = 1_000_000
# rows of one key that a task sorts by itself; keys with more are dealt into ranges
HOT = 1_000_000
# keys are first counted together by hash: few counts leave a task, however many keys it has
BUCKETS = 1 << 16


def has_hot_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key has more than ``HOT`` rows. Keys are counted one by one only where those of one hash together have more."""
    with freed_shuffles(df.sparkSession):
        for by in (F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("__bucket"),), keys:
            if df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > HOT).isEmpty():
                return False
    return True


def sorted_ranges(df: DataFrame, by: Sequence[Column], out: str) -> DataFrame:
    """``df`` dealt into ranges of the order ``by``, kept, with the ascending number of each row's range in ``out``."""
    return cut_lineage(df.repartitionByRange(*by).withColumn(out, F.spark_partition_id()))


def running_sums(ranged: DataFrame, keys: Sequence[str], sort: Sequence[Column], weight: str, part: str, out: str) -> DataFrame:
    """Sum of ``weight`` from the first row of a key to each of its rows, over rows dealt by ``sorted_ranges``.

    A range holds a key from its first row on only where the range before ends with that key, so the sums carried over
    are one row for each range at most.
    """
    upto = Window.partitionBy(part, *keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(part, *keys).agg(F.sum(weight).alias("__size"))
    carried = sizes.withColumn("__before", F.sum("__size").over(earlier)).where("__before > 0")
    carried = carried.select(F.col(part).alias("__in"), *[F.col(k).alias(f"__k_{k}") for k in keys], "__before")
    on = (ranged[part] == carried["__in"]) & null_safe(ranged, carried, [(k, f"__k_{k}") for k in keys])
    moved = ranged.withColumn(out, F.sum(weight).over(upto)).join(F.broadcast(carried), on, "left")
    return moved.withColumn(out, F.col(out) + F.coalesce("__before", F.lit(0))).drop("__in", "__before", *[f"__k_{k}" for k in keys])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, collapse: bool = True, where: Column | None = None,
) -> DataFrame:
    """Number the rows of every ``keys`` group from 1, ascending by ``order``.

    ``order`` lists columns (ascending, NULL last). The remaining columns are
    appended to make the order total; NULL keys are equal. ``collapse=False``
    says the rows are already distinct. Rows outside ``where`` are not numbered
    and get 0.

    The rows are kept. Where no key has more than ``HOT`` rows to number, a window numbers them with one shuffle.
    """
    df = cut_lineage(df)
    columns = df.columns
    rest = [c for c in columns if c not in keys and c not in order]
    sort = [F.col(c).asc_nulls_last() for c in [*order, *rest]]
    counted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    if not has_hot_key(df.where(counted), keys):
        numbered = df.where(counted).withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*sort)).cast("long"))
        return numbered if where is None else numbered.unionByName(df.where(~counted).withColumn(out, F.lit(0).cast("long")))
    if collapse:
        rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    else:
        rows = df.withColumn("__copies", F.lit(1).cast("long"))
    rows = rows.withColumn("__on", counted).withColumn("__weight", F.when(F.col("__on"), F.col("__copies")).otherwise(0))
    ranged = sorted_ranges(rows, [*[F.col(k) for k in keys], *sort], "__part")
    placed = running_sums(ranged, keys, sort, "__weight", "__part", "__end")
    if not collapse:
        return placed.select(*columns, F.when(F.col("__on"), F.col("__end")).otherwise(0).alias(out))
    chunked = placed.withColumn("__chunk", F.explode(F.expr(f"sequence(0, (__copies - 1) div {CHUNK})")))
    first = F.col("__end") - F.col("__copies") + F.col("__chunk") * CHUNK
    last = F.least(first + CHUNK, F.col("__end"))
    # copies that are not numbered are repeated all the same
    spread = F.when(F.col("__on"), F.sequence(first + 1, last)).otherwise(
        F.array_repeat(F.lit(0).cast("long"), F.least(F.lit(CHUNK), F.col("__copies") - F.col("__chunk") * CHUNK).cast("int")))
    return chunked.select(*columns, F.explode(spread).alias(out))


def place_ranks(base: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """One row for every place (``keys`` and ``order``, under the prefix ``__r_``) with its rank among the rows of ``base``.

    Equal places are counted first and their counts are summed over ranges, so only places are moved, not whole rows.
    """
    places = base.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("__n"))
    sort = [F.col(c).asc_nulls_last() for c in order]
    ranged = sorted_ranges(places, [*[F.col(k) for k in keys], *sort], "__part")
    placed = running_sums(ranged, keys, sort, "__n", "__part", "__end")
    return placed.select(*[F.col(c).alias(f"__r_{c}") for c in [*keys, *order]], (F.col("__end") - F.col("__n") + 1).alias(out))


def rank_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Rank within every ``keys`` group, ascending by ``order`` with NULL last; equal places share a rank and leave a gap.

    The ranks of places are joined back null-safely.
    """
    base = cut_lineage(df)
    ranks = place_ranks(base, keys, order, out)
    on = null_safe(base, ranks, [(c, f"__r_{c}") for c in [*keys, *order]])
    return base.join(ranks, on).select(*df.columns, out)


def pair_by_ordinal(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str], right_order: Sequence[str],
    out: str = "ordinal",
) -> DataFrame:
    """Every row of the left with the row of the right that has the same key and the same place within it, if there is one.

    (key, ordinal) is unique on both sides, so a hot key spreads over the join. Rows with a NULL in the key are numbered on
    the left and never pair; those of the right are left out before anything is numbered.
    """
    numbered_left = number_rows(left, keys, left_order, out)
    numbered_right = number_rows(right.dropna(subset=list(keys)), keys, right_order, out)
    return numbered_left.join(numbered_right, [*keys, out], "left")
