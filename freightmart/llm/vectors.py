"""Vector rows for the searches: which take part, blocks of bounded size, and the merge of partial results."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors, and queries, that meet in one task's step.
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 2048


def usable(vectors: DataFrame, zero: bool = True) -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part.

    Null ids, null or empty vectors and those with null or non-finite components do not; without ``zero`` zero vectors
    do not either.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.coalesce(finite, F.lit(False))
    return rows.where(good if zero else good & F.exists("vector", lambda x: x != 0))


def queries_of(rows: DataFrame, every: int) -> DataFrame:
    """Rows whose vec_id is divisible by ``every``; a repeated vec_id asks once, with its least vector."""
    return (rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("vector").alias("vector")))


def blocks(count: int, size: int) -> int:
    return max(1, -(-count // size))


def block_of(n: int | Column, *by: str) -> Column:
    """Block 0 to n - 1 of a row by a hash of its content, the same whenever it is computed again."""
    return F.pmod(F.xxhash64(*by), n if isinstance(n, Column) else F.lit(n)).cast("int")


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids; by partition, so that only the winners are sorted."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all blocks: query_id, rank, vec_id, score."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
