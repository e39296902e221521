"""Spelling variants: words that differ by one inserted, deleted or replaced letter, by PartEnum signatures.

A word is a binary vector over (letter, how often it came before): its multiset of letters. One replaced letter changes two
places of the vector, one inserted or deleted letter changes one. The places are dealt into PARTS partitions. Of words of one
length at least PARTS - 2 partitions agree, so every subset of that many partitions is a signature; of words whose
lengths differ by one, one of two pairs of partitions agrees. A signature also holds the length and one half of the word:
an edit lies in one half, the other is the same. Equal signatures are joined and every pair is verified by its edit
distance, so hash collisions cost time and change nothing.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .base import keep, pick

#: Bytes of text counted in one go.
STEP = 1 << 22
#: Runs of more bytes have their checksum taken one by one.
LONG = 64
PARTS, APART = 4, 2

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(_POLYNOMIAL) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table.astype(np.uint32)


_CRC = _crc_table()


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to A-Z, a-z or U+00C0 to U+00FF; those are 0xC3 and one more byte."""
    inside = W.within(data | np.uint8(0x20), 97, 122) & (data < 0x80)
    lead = data == 0xC3
    inside |= lead
    inside[1:] |= lead[:-1]
    return inside


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of data[start:end] for each pair, continued from the checksums ``before``."""
    length = end - start
    order = np.argsort(-np.minimum(length, LONG + 1).astype(np.int16), kind="stable")  # longest first
    length, start, state = length[order], start[order], ~before[order]
    long = int(np.count_nonzero(length > LONG))
    for k in range(int(length[long]) if long < len(length) else 0):
        upto = int(np.searchsorted(-length, -k, "left"))
        now = state[long:upto]
        state[long:upto] = _CRC[(now ^ data[start[long:upto] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    for i in range(long):
        state[i] = ~np.uint32(zlib.crc32(data[start[i]:start[i] + length[i]].tobytes(), int(before[order[i]])))
    out = np.empty_like(state)
    out[order] = ~state
    return out


def count_runs(every: int, least: int):
    """A function from batches of (id, text) to words and how often a step of the texts holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.Texts.of(batch.column(1))
            ids = batch.column(0).to_pylist()
            for part, inside, first in W.windows(texts, letters, STEP):
                made = _step_words(part, inside, ids[first:first + part.rows], every, least)
                if made.num_rows:
                    yield made
    return run


def _step_words(texts: W.Texts, inside: np.ndarray, ids: list, every: int, least: int) -> pa.RecordBatch:
    data = W.lower(texts.data)
    found = W.words(texts, inside)
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    marks = checksums(data, found.start, found.end, before[found.row])
    wide = np.concatenate([[0], np.cumsum(data == 0xC3)])
    points = found.end - found.start - (wide[found.end] - wide[found.start])
    spoilt = marks.astype(np.int64) % every == 0
    changed: Counter[str] = Counter()
    for i in np.flatnonzero(spoilt & (points > least)).tolist():
        word = data[found.start[i]:found.end[i]].tobytes().decode()
        at = int(marks[i]) % len(word)
        changed[word[:at] + word[at + 1:]] += 1
    plain = ~spoilt & (points >= least)
    start, end = found.start[plain], found.end[plain]
    _, index, counts = np.unique(W.hashes(data, start, end), return_index=True, return_counts=True)
    words = pa.concat_arrays([W.slices(data, start[index], end[index]), pa.array(list(changed), pa.string())])
    counts = np.concatenate([counts, np.fromiter(changed.values(), np.int64, len(changed))])
    return pa.RecordBatch.from_arrays([words, pa.array(counts, pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, every: int = 97, least: int = 5, times: int = 3) -> DataFrame:
    """word and n: words of at least ``least`` letters that occur at least ``times`` times.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. Where ``every`` divides the crc32 h of
    "id:run", the run loses its letter h % length: that plants the misspellings. A null id reads as an empty text there, a
    null text has no words. Within one step of some megabytes words are told apart by 64-bit hashes, else by their text.
    """
    rows = pick(docs, id="doc_id bigint", body="text string")
    counted = rows.mapInArrow(count_runs(every, least), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def latin(texts: W.Texts) -> W.Texts:
    """The same words with one byte for each letter."""
    own = ~W.within(texts.data, 0x80, 0xBF)
    code = texts.data[own]
    after = np.concatenate([texts.data[1:], np.zeros(1, np.uint8)])[own]
    return W.Texts(np.where(code == 0xC3, after + np.uint8(0x40), code), np.concatenate([[0], np.cumsum(own)])[texts.offsets])


def part_sums(texts: W.Texts) -> list[np.ndarray]:
    """For each partition the sum of the hashes of a word's places in it: equal for equal contents."""
    row = np.repeat(np.arange(texts.rows), np.diff(texts.offsets))
    keyed = np.sort(row << 8 | texts.data)
    at = np.arange(len(keyed))
    new = np.ones(len(keyed), bool)
    new[1:] = keyed[1:] != keyed[:-1]
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    place = W.mix(((keyed & 255) | ((nth + 1) << 8)).astype(np.uint64))
    part, value = place % np.uint64(PARTS), W.mix(place + np.uint64(1))
    sums = []
    for p in range(PARTS):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(part == p, value, np.uint64(0)))])
        sums.append(running[texts.offsets[1:]] - running[texts.offsets[:-1]])
    return sums


def keys(texts: W.Texts, longer: bool) -> list[np.ndarray]:
    """Signatures of each word: those it shares with words of its length, then those with words one letter longer, or, of
    the ``longer`` ones, with words one letter shorter."""
    start, end = texts.offsets[:-1], texts.offsets[1:]
    length = end - start
    sums = part_sums(texts)
    own = [(p, q) for p, q in combinations(range(PARTS), PARTS - APART)]
    out = []
    for kind, subsets in ((0, own), (1, [(0, 1), (2, 3)])):
        size = length - (kind == 1 and longer)
        half = size // 2
        halves = [W.hashes(texts.data, start, start + half), W.hashes(texts.data, end - (size - half), end)]
        for n, subset in enumerate(subsets):
            signature = (size * 64 + kind * 32 + n).astype(np.uint64)
            for p in subset:
                signature = W.mix(signature + sums[p])
            out += [W.mix(signature + W.mix(h + np.uint64(i))) for i, h in enumerate(halves)]
    return out


def signed(longer: bool):
    """A function from batches of (word, n) to one row for each signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = keys(latin(W.Texts.of(batch.column(0))), longer)
            for key in made:
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), batch.column(1)], ["key", "word", "n"])
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs a, b of words one edit apart, with their counts; b is the longer one, or the greater of one length."""
    shape = "key bigint, word string, n bigint"
    left = words.mapInArrow(signed(False), shape).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = words.mapInArrow(signed(True), shape).select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    shorter = F.char_length("a") < F.char_length("b")
    met = left.join(right, "key").where((shorter | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def follow(links: DataFrame) -> DataFrame:
    """word and root from word and form: forms are followed to the last. A form occurs at least twice as often as its word,
    so there are no rings and a chain is short; every round doubles the steps and is checkpointed."""
    table = keep(links.select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    while not table.where("open").isEmpty():
        further = table.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = table.where("open").join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("open"))
        table = keep(moved.unionByName(table.where("not open")))
    return table.select("word", "root")


def spelling_variants(docs: DataFrame, every: int = 97, least: int = 5, times: int = 3) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary (see ``vocabulary``).

    Near words differ by exactly one inserted, deleted or replaced letter. The form is the near word of largest n, of
    several the least in code-point order, if it occurs at least twice as often; the root is reached by following forms,
    and is the word itself where it has none. Repeated rows count repeatedly, other columns are not looked at, and an
    empty table has no words.
    """
    words = keep(vocabulary(docs, every, least, times))
    pairs = keep(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    # descending counts, then ascending words: the least such pair is the best near word
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    formed = words.join(best, "word", "left").withColumn("takes", -F.col("best.n") >= 2 * F.col("n"))
    formed = keep(formed.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(F.col("takes"), F.col("best.near")).alias("form"), F.when(F.col("takes"), -F.col("best.n")).alias("form_n")))
    roots = follow(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
