"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue over all its trees.

The trees are fitted on a bounded sample and sent to the tasks; every row is put into its leaf of every tree. A query
goes down all trees at once: the queue holds open nodes by the largest margin on the wrong side of a plane on the way,
and gives leaves until enough are reached. The rows of those leaves are ranked by their exact cosine.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import keep
from .vectors import BLOCK_QUERIES, BLOCK_VECTORS, best, block_of, blocks, merged, usable

#: Rows that the trees are fitted on, at most; which ones is decided by a hash of the row.
SAMPLE_ROWS = 20_000
TREES, DEPTH = 4, 8
#: Share of all leaves that a query reaches. Random directions need this much for a recall above 0.9.
REACH = 0.3
#: A query goes on until the leaves it reached in one tree hold so many rows, however large the table is.
LEAST_ROWS = 1280
#: Neighbouring leaves of a tree that are one group of the exact ranking.
GROUP_LEAVES = 16


@dataclass
class Forest:
    """Complete trees: planes (trees, inner nodes, dimensions) and cuts; node i has the children 2i + 1 and 2i + 2."""

    plane: np.ndarray
    cut: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree: (rows, trees)."""
        inner = self.cut.shape[1]
        out = np.zeros((len(x), len(self.cut)), np.int64)
        for t, (plane, cut) in enumerate(zip(self.plane, self.cut, strict=True)):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (np.einsum("ij,ij->i", x, plane[at]) > cut[at])
            out[:, t] = at - inner
        return out

    def reach(self, margin: np.ndarray, wanted: int, held: np.ndarray | None = None, least: int = 0) -> list[tuple[int, int]]:
        """(tree, leaf) of the first ``wanted`` leaves, and of more until those of one tree hold ``least`` rows.

        ``margin`` (trees, inner nodes) is the query's side of each plane, ``held`` (trees, leaves) the rows of each leaf.
        """
        rows_of = [0] * len(self.cut)
        inner = self.cut.shape[1]
        queue = [(0.0, t, 0) for t in range(len(self.cut))]
        found = []
        rows = margin.tolist()
        while queue and (len(found) < wanted or max(rows_of) < least):
            worst, t, node = heapq.heappop(queue)
            if node >= inner:
                found.append((t, node - inner))
                rows_of[t] += 0 if held is None else int(held[t, node - inner])
                continue
            side = rows[t][node]
            heapq.heappush(queue, (max(worst, side), t, 2 * node + 1))
            heapq.heappush(queue, (max(worst, -side), t, 2 * node + 2))
        return found


def fit_forest(sample: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> Forest:
    """Planes between two random rows of the node, cut at the median."""
    rng = np.random.default_rng(seed)
    inner = 2**depth - 1
    plane, cut = np.zeros((trees, inner, sample.shape[1])), np.zeros((trees, inner))
    for t in range(trees):
        rows = [np.arange(len(sample))] + [np.zeros(0, np.int64)] * (2 * inner)
        for node in range(inner):
            own = rows[node]
            normal = rng.standard_normal(sample.shape[1])
            if len(own) > 1:
                a, b = sample[rng.choice(own, 2, replace=False)]
                normal = a - b if np.any(a != b) else normal
            normal = normal / np.linalg.norm(normal)
            side = sample[own] @ normal
            plane[t, node], cut[t, node] = normal, np.median(side) if len(own) else 0.0
            rows[2 * node + 1], rows[2 * node + 2] = own[side <= cut[t, node]], own[side > cut[t, node]]
    return Forest(plane, cut)


def unit(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of ``width`` components and the same at length 1; scaled first, so that no square overflows."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    y = x / np.abs(x).max(axis=1, keepdims=True)
    return x, y / np.sqrt((y * y).sum(axis=1, keepdims=True))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The ``k`` nearest found rows by cosine for each query: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows with another vec_id. Rows with null,
    empty, zero or non-finite vectors take no part, nor do those whose length is not the commonest one (ties: the
    smaller); a repeated vec_id is several candidates and one query, also where the vectors are equal; ties go to the
    smaller vec_id. A query reaches REACH of the leaves and goes on until those of one tree hold LEAST_ROWS rows and ``k``
    with another vec_id: none lacks results, and a table of at most LEAST_ROWS rows is searched exactly. An empty table
    gives no rows. Other columns are not looked at.
    """
    schema = "query_id bigint, vec_id bigint, row bigint, score double"
    rows = usable(vectors, zero=False)
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return merged(rows.sparkSession.createDataFrame([], schema), k)
    width = int(widths["width"])
    # the number names a row in all its trees; kept, so that it is the same whenever a task runs again
    rows = keep(rows.where(F.size("vector") == width).withColumn("row", F.monotonically_increasing_id()))
    counts = rows.agg(F.count_distinct(F.when(F.pmod("vec_id", F.lit(every)) == 0, F.col("vec_id"))).alias("q")).first()
    sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(sample_rows).select("vector").toPandas()
    x = np.array(sample["vector"].tolist(), float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    forest = fit_forest(x / np.sqrt((x * x).sum(axis=1, keepdims=True)))
    leaves = 2**DEPTH
    groups = leaves // GROUP_LEAVES
    reach = max(1, round(REACH * TREES * leaves))

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = forest.leaves(unit(batch.column(1), width)[1])
                row = pa.array(np.repeat(np.arange(batch.num_rows), TREES))
                tree = np.tile(np.arange(TREES), batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((tree * groups + leaf.ravel() // GROUP_LEAVES).astype(np.int32)), batch.column(0).take(row), batch.column(1).take(row), batch.column(2).take(row),
                     pa.array((np.int64(1) << (leaf.ravel() % GROUP_LEAVES)).astype(np.int32))], ["g", "vec_id", "vector", "row", "mask"])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            u = unit(batch.column(1), width)[1]
            margin = np.einsum("qd,tnd->qtn", u, forest.plane, optimize=True) - forest.cut[None]
            out: list[tuple[int, int, int]] = []
            own = batch.column(2).to_pylist()
            for i in range(len(u)):
                masks: dict[int, int] = {}
                for tree, leaf in forest.reach(margin[i], reach, held, max(LEAST_ROWS, k + own[i])):
                    g = tree * groups + leaf // GROUP_LEAVES
                    masks[g] = masks.get(g, 0) | 1 << leaf % GROUP_LEAVES
                out += [(g, i, mask) for g, mask in masks.items()]
            g, i, mask = np.array(out, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), batch.column(0).take(pa.array(i)), batch.column(1).take(pa.array(i)),
                                              pa.nulls(len(i), pa.int64()), pa.array(mask.astype(np.int32))], ["g", "vec_id", "vector", "row", "mask"])

    kind = "g int, vec_id bigint, vector array<double>, row bigint, mask int"
    index = rows.select("vec_id", "vector", "row").mapInArrow(indexed, kind)
    # large groups are cut into blocks by their counted sizes: one number for each of the TREES * leaves leaves
    held = np.zeros((TREES, leaves), np.int64)
    for r in index.groupBy("g", "mask").count().collect():
        held[r["g"] // groups, r["g"] % groups * GROUP_LEAVES + (int(r["mask"]).bit_length() - 1)] = r["count"]
    sizes = dict(enumerate(held.reshape(TREES * groups, GROUP_LEAVES).sum(axis=1).tolist()))
    n = F.element_at(F.array(*(F.lit(blocks(sizes.get(g, 0), BLOCK_VECTORS)) for g in range(TREES * groups))), F.col("g") + 1)
    m = blocks(counts["q"], BLOCK_QUERIES)
    # with the number of rows of its vec_id, which are no candidates
    every_query = (rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"), F.count("*").alias("own"))).repartition(blocks(counts["q"], 256), "vec_id")
    grid = (index.select("g", F.lit(False).alias("asks"), block_of(n, "row").alias("i"),
                         F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("j"), "vec_id", "vector", "row", "mask")
            .unionByName(every_query.mapInArrow(routed, kind).select(
                "g", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), n - 1)).alias("i"), block_of(m, "vec_id").alias("j"),
                "vec_id", "vector", "row", "mask")))

    def ranked(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(group)).combine_chunks()
        asks, ids, mask = table["asks"].to_numpy(), table["vec_id"].to_numpy(), table["mask"].to_numpy()
        if asks.all() or not asks.any():
            return
        _, u = unit(table["vector"].combine_chunks(), width)
        rows, row_ids, row_mask = u[~asks], ids[~asks], mask[~asks]
        number = table["row"].combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False)[~asks]
        out = []
        for at in range(0, int(asks.sum()), 256):
            part = slice(at, at + 256)
            q, q_ids, q_mask = u[asks][part], ids[asks][part], mask[asks][part]
            near = q @ rows.T
            near[(q_mask[:, None] & row_mask[None, :]) == 0] = -np.inf
            near[q_ids[:, None] == row_ids[None, :]] = -np.inf
            for i, scores in enumerate(near):
                # matrix products round by place: what may be among the best is summed again in one fixed order
                least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else -np.inf
                near_best = np.flatnonzero((scores >= least - 1e-9) & (scores > -np.inf))
                exact = (rows[near_best] * q[i]).sum(axis=1)
                top = best(exact, row_ids[near_best], k)
                out.append((np.full(len(top), q_ids[i]), row_ids[near_best[top]], number[near_best[top]], exact[top]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "row", "score"])

    # a row lies in one leaf of every tree: by its number the copies of a result are one again before the merge
    found = grid.groupBy("g", "i", "j").applyInArrow(ranked, schema).dropDuplicates(["query_id", "row"])
    return merged(found, k)
