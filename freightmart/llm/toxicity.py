"""Toxicity: cumulative-link ordinal regression over sparse text features.

One weight vector serves all ordered thresholds: P(grade >= j) = sigmoid(weights . features - threshold_j).
Labels only say toxic or not; the grades of toxic training rows are the thirds of how much toxic wording they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import keep, pick, steps
from .quality import held_out
from .trees import sigmoid

#: Labelled rows that the weights are fitted on, at most; which ones is decided by a hash of doc_id.
SAMPLE_ROWS = 20_000
#: Features are hashed into so many buckets; so many of them at most get a weight.
BUCKETS, FEATURES = 1 << 18, 4_000
#: Words count whole and by their first bytes, so that inflected forms meet.
PREFIXES = (4, 5, 6, 7)
#: A feature must be found in so many toxic documents, and be so much (as a logarithm) commoner there.
LEAST_DOCS, LEAST_LOG_ODDS = 6, 2.0
GRADES = 3
GIVEN = ("__severity", "__grade", "__toxic")


def buckets(texts: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every word and word beginning; words are runs of letters, A-Z in lower case."""
    data = W.lower(texts.data)
    found = W.words(texts, W.within(data, 97, 122) | (data >= 128))
    ends = [found.end, *(np.minimum(found.start + n, found.end) for n in PREFIXES)]
    rows, made = [], []
    for i, hashed in enumerate(W.prefix_hashes(data, found.start, found.end, ends)):
        use = slice(None) if i == 0 else found.start + PREFIXES[i - 1] < found.end
        rows.append(found.row[use])
        made.append(((hashed[use] + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 18))
    return np.concatenate(rows), np.concatenate(made).astype(np.int64)


@dataclass
class Ordinal:
    weight: np.ndarray  # of each bucket
    thresholds: np.ndarray  # ascending, one for each grade above 0
    cut: float  # a document counts as toxic from this margin on

    def margins(self, texts: W.Texts) -> np.ndarray:
        row, bucket = buckets(texts)
        hit = self.weight[bucket] != 0
        key, count = np.unique(row[hit] * BUCKETS + bucket[hit], return_counts=True)
        return np.bincount(key // BUCKETS, self.weight[key % BUCKETS] * (2 - 1 / count), texts.rows)

    def at_least(self, margin: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j from 1: (rows, grades)."""
        return sigmoid(margin[:, None] - self.thresholds[None, :])


def fit_ordinal(row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int,
                rounds: int = 1500, rate: float = 0.1, ridge: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights, none below 0, and ascending thresholds of the largest likelihood with a ridge term, by Adam over all rows."""
    n, levels = len(grade), int(GRADES)
    # thresholds are a first value and positive gaps, so they stay in order
    theta = np.concatenate([np.zeros(width), [1.0], np.zeros(levels - 1)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        weight, gaps = theta[:width], np.exp(theta[width + 1:])
        cuts = theta[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(row, weight[feature] * value, n)
        above = np.concatenate([np.ones((n, 1)), sigmoid(eta[:, None] - cuts), np.zeros((n, 1))], axis=1)
        a, b = above[np.arange(n), grade], above[np.arange(n), grade + 1]
        pull = 1 - a - b
        p = np.maximum(a - b, 1e-9)
        by_cut = np.zeros(levels + 2)
        np.add.at(by_cut, grade, -a * (1 - a) / p)
        np.add.at(by_cut, grade + 1, b * (1 - b) / p)
        by_cut = by_cut[1:-1]
        slope = np.concatenate([np.bincount(feature, pull[row] * value, width) / n - ridge * weight,
                                [by_cut.sum() / n], np.cumsum(by_cut[::-1])[::-1][1:] * gaps / n])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        theta[:width] = np.maximum(theta[:width], 0)
    return theta[:width], theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1:]))])


def best_cut(margin: np.ndarray, toxic: np.ndarray) -> float:
    """The margin that errs on fewest rows, in the middle of the gap below it: grades pull the first threshold, this is free of them."""
    level, at = np.unique(margin, return_inverse=True)
    bad_below = np.cumsum(np.bincount(at, toxic, len(level)))
    bad_above = np.bincount(at, ~toxic, len(level))[::-1].cumsum()[::-1]
    errors = np.concatenate([[0], bad_below]) + np.concatenate([bad_above, [0]])
    i = int(np.argmin(errors))
    return float("-inf") if i == 0 else float("inf") if i == len(level) else float(level[i - 1] + level[i]) / 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Ordinal:
    """Model from at most ``sample_rows`` labelled documents that are not held out (the rule of the quality classifier).

    The sample of labels is broadcast, its bound is the parameter. Which buckets get a weight is decided by counts
    over the whole sample, made by Spark; the driver gets FEATURES buckets and the sample's rows in them.
    """
    known = (pick(labels, id="doc_id bigint", label="toxic double").where("id is not null and label between 0 and 1")
             .groupBy("id").agg(F.max("label").alias("label")))
    sample = known.where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(sample_rows)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1):
            texts = W.Texts.of(batch.column(1))
            row, bucket = buckets(texts)
            key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
            ends = np.searchsorted(key // BUCKETS, np.arange(texts.rows + 1)).astype(np.int32)
            lists = lambda v: pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), lists(key % BUCKETS), lists(count)],
                                             ["id", "label", "bucket", "n"])

    rows = keep(pick(docs, id="doc_id bigint", text="text string").join(F.broadcast(sample), "id").select("id", "text", "label")
                .mapInArrow(found, "id bigint, label double, bucket array<int>, n array<int>"))
    toxic, all_rows = (int(x or 0) for x in rows.agg(F.sum((F.col("label") > 0.5).cast("long")), F.count("*")).first())
    nothing = Ordinal(np.zeros(BUCKETS), np.full(GRADES, 40.0), float("inf"))
    if not toxic:
        return nothing
    # one long of counts: toxic documents, others
    stats = (rows.select((F.col("label") > 0.5).cast("long").alias("toxic"), F.explode("bucket").alias("bucket"))
             .groupBy("bucket").agg(F.sum("toxic").alias("a"), (F.count("*") - F.sum("toxic")).alias("b")).where(F.col("a") >= LEAST_DOCS))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (all_rows - toxic + 1))
    chosen = (stats.select("bucket", odds.alias("odds"), (odds * F.sqrt("a")).alias("worth"))
              .where(F.col("odds") >= LEAST_LOG_ODDS).orderBy(F.desc("worth"), "bucket").limit(FEATURES).toPandas())
    if not len(chosen):
        return nothing
    place = {int(b): i for i, b in enumerate(chosen["bucket"])}
    at = np.full(BUCKETS, -1, np.int32)
    at[list(place)] = np.arange(len(place))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, hit = at[pc.list_flatten(batch.column(2)).to_numpy()], pc.list_parent_indices(batch.column(2)).to_numpy()
            hit, use = hit[features >= 0], features >= 0
            ends = np.concatenate([[0], np.cumsum(np.bincount(hit, minlength=batch.num_rows))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v[use])) for v in (features, pc.list_flatten(batch.column(3)).to_numpy())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], ["id", "label", "bucket", "n"])

    slim = (rows.mapInArrow(wanted, "id bigint, label double, bucket array<int>, n array<int>").toPandas()
            .sort_values("id", kind="stable", ignore_index=True))
    row = np.repeat(np.arange(len(slim)), slim["bucket"].map(len))
    feature = np.concatenate([*slim["bucket"], np.zeros(0)]).astype(np.int64)
    count = np.concatenate([*slim["n"], np.zeros(0)])
    held = np.bincount(row, count, len(slim))
    is_toxic = slim["label"].to_numpy() > 0.5
    bounds = np.quantile(held[is_toxic], [i / GRADES for i in range(1, GRADES)])
    grade = np.where(is_toxic, 1 + np.searchsorted(bounds, held, "left"), 0).astype(np.int64)
    weight, thresholds = fit_ordinal(row, feature, 2 - 1 / count, grade, len(place))
    full = np.zeros(BUCKETS)
    full[list(place)] = weight
    margin = np.bincount(row, weight[feature] * (2 - 1 / count), len(slim))
    return Ordinal(full, thresholds, best_cut(margin, is_toxic))


def toxicity_grades(docs: DataFrame, model: Ordinal, *carry: str) -> DataFrame:
    """``carry`` columns of every document with the columns GIVEN: severity (expected grade), grade (thresholds that are
    likelier passed than not) and toxic (1 from the fitted margin on). Their names clash with none of a table's own."""
    columns = [F.col(f"`{c}`") for c in carry]
    names = list(carry)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, len(names)):
            margin = model.margins(W.Texts.of(batch.column(len(names))))
            above = model.at_least(margin)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(above.sum(axis=1)), pa.array((above >= 0.5).sum(axis=1).astype(np.int32)),
                 pa.array((margin >= model.cut).astype(np.int32))], [*names, *GIVEN])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema.fields)
    return (docs.select(*columns, F.col("text").cast("string").alias("__text"))
            .mapInArrow(scored, f"{fields}, {GIVEN[0]} double, {GIVEN[1]} int, {GIVEN[2]} int"))


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Grade of every document row: doc_id, held_out, severity (0 to 3), grade, toxic.

    Several label rows of a document count as toxic if one does; null labels are left out. Null and empty texts hold no
    feature and get the grade of an empty text; equal doc_ids are graded row by row; without toxic labels all get grade 0.
    """
    model = fit_toxicity(docs, labels, sample_rows)
    graded = toxicity_grades(pick(docs, doc_id="doc_id bigint", text="text string"), model, "doc_id")
    given = [F.col(c).alias(c.removeprefix("__")) for c in GIVEN]
    return graded.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *given)
