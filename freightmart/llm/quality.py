"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on the driver from a bounded sample of labelled rows and flattened into arrays;
tasks compute the statistics of whole texts with numpy and send all rows of a step down all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import pick, steps
from .trees import Boosted, fit

#: Labelled rows that the trees are fitted on, at most; which ones is decided by a hash of doc_id.
SAMPLE_ROWS = 20_000
#: A document is kept from this score on.
GOOD = 0.7
GIVEN = ("__score", "__predicted")


def held_out(doc_id):
    """crc32 of doc_id as text leaves 2 modulo 4: never learnt from. A null doc_id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def statistics(texts: W.Texts) -> np.ndarray:
    """One row of figures for each text; empty texts get zeros."""
    rows, sizes = texts.rows, np.diff(texts.offsets)
    counts = np.zeros((rows, 256))
    for i, (a, b) in enumerate(zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)):
        for at in range(a, b, W.BLOCK):
            counts[i] += np.bincount(texts.data[at:min(b, at + W.BLOCK)], minlength=256)
    size = np.maximum(sizes, 1)[:, None]
    share = counts / size
    some = lambda *codes: share[:, list(codes)].sum(axis=1)
    upper, small, digit = share[:, 65:91].sum(axis=1), share[:, 97:123].sum(axis=1), share[:, 48:58].sum(axis=1)
    marks = share[:, 33:127].sum(axis=1) - upper - small - digit
    logs = np.where(share > 0, np.log2(np.where(share > 0, share, 1)), 0)

    found = W.words(texts)
    hashed = W.hashes(W.lower(texts.data), found.start, found.end)
    ends = found.per_row(rows)
    n = np.maximum(np.diff(ends), 1)
    length = found.end - found.start
    total = lambda v: np.diff(np.concatenate([[0.0], np.cumsum(v, dtype=float)])[ends])
    again = np.zeros(len(hashed))
    again[1:] = (hashed[1:] == hashed[:-1]) & (found.row[1:] == found.row[:-1])
    different = np.diff(W.distinct(hashed, ends)[1])
    triples, at = W.shingles(hashed, ends, 3)
    different3 = np.diff(W.distinct(triples, at)[1])
    longest = np.zeros(rows)
    np.maximum.at(longest, found.row, length)
    first, last = texts.data[found.start], texts.data[found.end - 1]
    mark_end = total(((last < 48) | W.within(last, 58, 64) | W.within(last, 91, 96) | W.within(last, 123, 126)) & (last < 128) & (last != 0x2E) & (last != 0x2C))
    inner = W.words(texts, texts.data != 0x0A)
    lines = inner.per_row(rows)
    line_hash = W.hashes(texts.data, inner.start, inner.end)
    n_lines = np.maximum(np.diff(lines), 1)
    return np.stack([
        np.log1p(sizes), np.log1p(np.diff(ends)), total(length) / n, np.sqrt(np.maximum(total(length**2) / n - (total(length) / n)**2, 0)), np.log1p(longest),
        upper, digit, marks, share[:, 128:].sum(axis=1), some(0x20, 9, 10, 11, 12, 13), some(0x0A), some(0x21), some(0x7C), some(0x2E), some(0x2C),
        marks - some(0x21, 0x7C, 0x2E, 0x2C), -(share * logs).sum(axis=1), different / n, different3 / n, total(again) / n,
        mark_end / n, total(W.within(first, 65, 90)) / n, total(length == 1) / n, np.diff(W.distinct(line_hash, lines)[1]) / n_lines, np.log1p(sizes / n_lines),
    ], axis=1).astype(np.float32)


def _with_statistics(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in steps(batches, text):
        yield batch, statistics(W.Texts.of(batch.column(text)))


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Boosted:
    """Trees from at most ``sample_rows`` labelled documents that are not held out.

    Several label rows of a document count by their mean; null labels are left out. The sample of labels
    is broadcast: its size is bounded by the parameter.
    """
    known = (pick(labels, id="doc_id bigint", label="quality double").where("id is not null and label between 0 and 1")
             .groupBy("id").agg(F.avg("label").alias("label")))
    sample = known.where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(sample_rows)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _with_statistics(batches, 1):
            yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "x": [row.tobytes() for row in x]})

    rows = (pick(docs, id="doc_id bigint", text="text string").join(F.broadcast(sample), "id").select("id", "text", "label")
            .mapInArrow(figures, "label double, x binary").toPandas())
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1) if len(rows) else np.zeros((0, 1), np.float32)
    order = np.lexsort([*x.T, rows["label"]]) if len(rows) else []
    return fit(x[order], rows["label"].to_numpy(float)[order])


def quality_scores(docs: DataFrame, model: Boosted, *carry: str, good: float = GOOD) -> DataFrame:
    """``carry`` columns of every document with the columns GIVEN, score and predicted, under names that clash with none of a
    table's own; null and empty texts get the score of an empty text."""
    columns = [F.col(f"`{c}`") for c in carry]
    source = docs.select(*columns, F.col("text").cast("string").alias("__text"))
    names = list(carry)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _with_statistics(batches, len(names)):
            score = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array((score >= good).astype(np.int32))], [*names, *GIVEN])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema.fields)
    return source.mapInArrow(scored, f"{fields}, {GIVEN[0]} double, {GIVEN[1]} int")


def quality_classifier(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Score of every document row: doc_id, held_out, score (0 to 1), predicted (1 from GOOD on).

    Rows with equal doc_id are scored one by one, a null doc_id stays null, an empty table gives no rows,
    and without usable labels every score is 0.5. Other columns are not looked at.
    """
    model = fit_quality(docs, labels, sample_rows)
    ids = pick(docs, doc_id="doc_id bigint", text="text string")
    given = [F.col(c).alias(c.removeprefix("__")) for c in GIVEN]
    return quality_scores(ids, model, "doc_id").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *given)
