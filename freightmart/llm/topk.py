"""Exact top-k by exhaustive term-at-a-time accumulation.

A vector is a sparse row: dimension is the term, the whole number floor(64 * x) its weight. A block of rows is held as
postings of each term; a block of queries goes through its terms one after the other and adds weight times posting
to dense score arrays. The best of each block are found by partition, and the blocks' winners are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import BLOCK_QUERIES, BLOCK_VECTORS, best, block_of, blocks, merged, queries_of, usable

SCALE = 64
#: Queries whose score arrays are filled together, so that a step's scores stay in the processor's cache.
TOGETHER = 64


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers, short ones filled with zeros: a term that a row lacks has no weight."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = (
        column.flatten().to_numpy(zero_copy_only=False))
    return out


def accumulate(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Scores (rows, queries) by adding up one term after the other."""
    terms = min(rows.shape[1], queries.shape[1])
    largest = int(np.abs(rows).max(initial=0)) * int(np.abs(queries).max(initial=0)) * terms
    kind = np.int32 if largest < 2**31 else np.int64
    scores = np.zeros((len(rows), len(queries)), kind)
    for term in range(terms):
        weight, posting = queries[:, term].astype(kind), np.flatnonzero(rows[:, term])
        if not weight.any() or not len(posting):
            continue
        value = rows[:, term].astype(kind)
        if len(posting) > len(rows) // 2:  # a dense term: adding zeros is cheaper than picking rows
            scores += value[:, None] * weight[None, :]
        else:
            scores[posting] += value[posting, None] * weight[None, :]
    return scores


def exact_top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = SCALE) -> DataFrame:
    """The ``k`` rows with the largest inner product of whole numbers, for each query: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows with another vec_id. Rows with null,
    empty, or non-finite vectors take no part; a dimension that a vector lacks counts as 0; a repeated vec_id is several
    candidates and one query; ties go to the smaller vec_id. Products must fit 64-bit whole numbers. Other columns are
    not looked at; an empty table gives no rows.
    """
    rows = usable(vectors).select("vec_id", F.transform("vector", lambda x: F.floor(x * scale)).alias("vector"))
    queries = queries_of(rows, every)
    counts = rows.agg(F.count("*").alias("n"), F.count_distinct(F.when(F.pmod("vec_id", F.lit(every)) == 0, F.col("vec_id"))).alias("q")).first()
    n, m = blocks(counts["n"], BLOCK_VECTORS), blocks(counts["q"], BLOCK_QUERIES)
    # every block of queries meets every block of rows once
    grid = (rows.select(F.lit(False).alias("asks"), block_of(n, "vec_id", "vector").alias("i"),
                        F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("j"), "vec_id", "vector")
            .unionByName(queries.select(F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"),
                                        block_of(m, "vec_id").alias("j"), "vec_id", "vector")))

    def search(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(group)).combine_chunks()
        asks = table["asks"].combine_chunks().to_numpy(zero_copy_only=False)
        ids = table["vec_id"].to_numpy()
        vectors = matrix(table["vector"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int64())))
        rows, queries, row_ids, query_ids = vectors[~asks], vectors[asks], ids[~asks], ids[asks]
        if not len(rows):
            return
        for at in range(0, len(queries), TOGETHER):
            part = np.ascontiguousarray(accumulate(rows, queries[at:at + TOGETHER]).T)
            out = []
            for query, scores in zip(query_ids[at:at + TOGETHER].tolist(), part, strict=True):
                own = row_ids == query
                known, scores = (row_ids[~own], scores[~own]) if own.any() else (row_ids, scores)
                top = best(scores, known, k)
                out.append((np.full(len(top), query), known[top], scores[top].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    return merged(grid.groupBy("i", "j").applyInArrow(search, "query_id bigint, vec_id bigint, score bigint"), k)
