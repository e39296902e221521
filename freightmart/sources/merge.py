"""A stored reference table kept up to date from an import, by rewriting only what changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.upsert import add_missing, fill_missing
from ..session import cut_lineage
from .publish import Target


def bucket(key: str, buckets: int) -> Column:
    """Which of the target's folders a key belongs to; the label also says how many there are."""
    return F.concat(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("string"), F.lit(f"-{buckets}"))


def store_bucketed(target: Target, rows: DataFrame, key: str, buckets: int = 64) -> None:
    """Publish ``rows`` dealt into folders by ``key``."""
    target.refresh(rows, bucket(key, buckets))


def merge_import(
    target: Target, incoming: DataFrame, key: str, empty: Column, fill: Sequence[str], values: Mapping[str, Column], buckets: int = 64,
) -> DataFrame:
    """Fill and extend a target written by ``store_bucketed``; returns its changed rows with ``change``, filled or added.

    Where ``empty`` holds on a stored row and the import knows its key, the ``fill`` columns are taken from the import; keys
    that are not stored are added with ``values``. ``incoming`` has one row per key; rows without a key are left out.
    Only the buckets that hold keys of the import are read, and only those with a changed row are written anew: all other
    files stay. The names of buckets are all that comes to the driver.
    """
    by = bucket(key, buckets)
    with target.store.change() as change:
        other = {s.label for s in change.start.tables[target.name].segments if not str(s.label).endswith(f"-{buckets}")}
        if other:
            raise ValueError(f"{target.name} is not dealt into {buckets} buckets")
        side = cut_lineage(incoming.dropna(subset=[key]))

        def buckets_of(rows: DataFrame) -> list[str]:
            return [r.label for r in rows.select(by.alias("label")).distinct().collect()]

        stored = change.start.read(target.name, buckets_of(side))
        new = side.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in fill])
        differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__new_{c}")) for c in fill])
        filled = stored.join(new, stored[key] == new["__key"]).where(empty & differs).select(key, F.lit("filled").alias("change"))
        added = side.join(stored.select(key), key, "left_anti").select(key, F.lit("added").alias("change"))
        marks = cut_lineage(filled.unionByName(added).distinct())
        touched = buckets_of(marks)
        if touched:
            ours = side.where(by.isin(touched))
            part = fill_missing(change.start.read(target.name, touched), ours, key, empty, fill)
            change.swap(target.name, add_missing(part, ours, key, values), by, touched)
    return target.read(touched).join(marks, key)
