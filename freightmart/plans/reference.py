"""Item weight reference kept up to date from an import file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import literals as fixed
from ..functions.semantics import pad_code
from ..operators.upsert import add_missing, fill_missing


def import_items(rows: DataFrame) -> DataFrame:
    """One row per item code, the heaviest first, an unknown weight before any.

    ``rows``: code, article, name, unit, weight (article may end in ".0"). The
    code is grouped as typed and padded afterwards, as the import always did;
    one aggregate with partial combine picks the row.
    """
    clean = rows.withColumn("article", F.replace(F.col("article"), F.lit(".0"), F.lit("")))
    best = F.max(F.struct(F.col("weight").isNull().alias("unknown"), "weight", "article", "name", "unit")).alias("best")
    return clean.groupBy("code").agg(best).select(
        pad_code("code").alias("code"), *[F.col(f"best.{c}").alias(c) for c in ("article", "name", "unit", "weight")]
    )


def update_item_reference(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Fill weight and unit where the stored weight is unknown or zero, then add new codes.

    ``stored``: code, article, name, unit, weight, factor. ``incoming`` from
    ``import_items``. Running it twice changes nothing more, unless the import
    itself has no weight. Two import codes that pad to the same text would
    both apply; the heavier is taken first.
    """
    once = incoming.groupBy("code").agg(
        F.max(F.struct(F.col("weight").isNull().alias("unknown"), "weight", "article", "name", "unit")).alias("best")
    ).select("code", *[F.col(f"best.{c}").alias(c) for c in ("article", "name", "unit", "weight")])
    filled = fill_missing(stored, once, "code", F.coalesce(F.col("weight") == 0, F.lit(True)), ["weight", "unit"])
    values = {c: F.col(c) for c in ("code", "article", "name", "unit", "weight")}
    return add_missing(filled, once, "code", {**values, "factor": F.lit(fixed.WEIGHT_VOLUME_FACTOR)})
