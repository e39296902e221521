"""Collocations: phrases of up to five words that occur often, scored by their weakest cut.

The first pass finds which phrases can be frequent. Phrases are hashed, the hash space is cut into partitions, and each
partition's counts go through a Misra-Gries summary with more counters than the partition's mass divided by the
threshold: whatever reaches the threshold survives. It runs for words and pairs first, then for three to five words, which
are looked at only where all pairs inside survived. The survivors are held as a bit map of bounded size. The second pass
reads all texts again and counts, by their text, the phrases the map knows: hash collisions and false survivors are
counted too and then left out by their exact count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .base import keep, pick

#: Words of the longest phrase.
MOST = 5
#: Bytes of text that one step counts.
STEP = 1 << 22
#: Phrase occurrences that a hash partition holds on average at most; items gathered before they are merged.
PART_MASS, GATHER = 1 << 24, 1 << 22
#: Bits of a survivors' map for each survivor, and the most bits of a map. A fuller map lets more infrequent phrases
#: through to the exact count and changes no result.
BITS_EACH, MOST_BITS = 32, 1 << 30
#: Parts of a language whose best phrases are found apart before they are ranked together.
RANK_PARTS = 64


def not_separators(data: np.ndarray) -> np.ndarray:
    """Which bytes do not end a piece: all but . , ; : ! ? and 0x0A to 0x0D."""
    ends = W.within(data, 0x0A, 0x0D)
    for c in b".,;:!?":
        ends |= data == c
    return ~ends


class Step:
    """Words of some texts, joined by single spaces, and the hashes of the phrases that start at each word."""

    def __init__(self, texts: W.Texts, inside: np.ndarray, languages: pa.Array):
        data = W.lower(texts.data)
        found = W.words(texts, inside & (data != 0x20) & (data != 0x09))
        self.row, self.languages, n = found.row, languages, len(found.start)
        ends = np.concatenate([[0], np.cumsum(~inside)])
        starts_piece = np.ones(n, bool)
        starts_piece[1:] = (found.row[1:] != found.row[:-1]) | (ends[found.start[1:]] != ends[found.end[:-1]])
        piece = np.append(np.flatnonzero(starts_piece), n)
        #: words from each one to the end of its piece
        self.room = np.repeat(piece[1:], np.diff(piece)) - np.arange(n)
        self.data, self.found, self.hashes = data, found, W.hashes(data, found.start, found.end)
        known, code = np.unique(languages.to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        raw = [name.encode() for name in known]
        at = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        self.salt = W.hashes(np.frombuffer(b"".join(raw) + b" ", np.uint8), at[:-1], at[1:])[code][found.row]

    def phrases(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For one to ``most`` words: the number of words, the first words of all such phrases, their 64-bit hashes."""
        n = len(self.hashes)
        total, padded = self.salt.copy(), np.concatenate([self.hashes, np.zeros(MOST, np.uint64)])
        for m, weight in enumerate(W.powers(MOST + 1)[1:most + 1], start=1):
            total += padded[m - 1:m - 1 + n] * weight
            first = np.flatnonzero(self.room >= m)
            yield m, first, W.mix(total[first] + np.uint64(m))

    def survivors(self, short: BitMap, long: BitMap | None = None, most: int = MOST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Phrases of which the maps know every part that they can; without ``long`` all of three and more words."""
        alive = np.zeros(len(self.hashes) + MOST, bool)
        for m, first, hashed in self.phrases(most):
            if m <= 2:
                hit = short.knows(hashed)
                if m == 2:
                    alive[first[hit]] = True
            else:
                hit = alive[first] & alive[first + m - 2]
                for i in range(1, m - 2):
                    hit &= alive[first + i]
                if long is not None:
                    hit[hit] = long.knows(hashed[hit])
            yield m, first[hit], hashed[hit]

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space between them as bytes, and where each begins and ends."""
        length = self.found.end - self.found.start
        start = np.concatenate([[0], np.cumsum(length + 1)])
        out = np.full(start[-1], 0x20, np.uint8)
        within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(start[:-1], length) + within] = self.data[np.repeat(self.found.start, length) + within]
        return out, start[:-1], start[:-1] + length


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys with the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


class Summary:
    """Misra-Gries counters of one hash partition: with more than mass / threshold counters, no key that occurs
    ``threshold`` times is lost, and no key's count is short by more than ``taken``, which stays below the threshold."""

    def __init__(self, mass: int, threshold: int):
        self.counters, self.threshold, self.taken = mass // threshold + 1, threshold, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge further counts in, then take as much from all counters as leaves no more than there may be."""
        self.keys, self.counts = added(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        if len(self.keys) > self.counters:
            place = len(self.counts) - self.counters - 1
            least = int(np.partition(self.counts, place)[place])
            stay = self.counts > least
            self.keys, self.counts, self.taken = self.keys[stay], self.counts[stay] - least, self.taken + least

    def survivors(self) -> np.ndarray:
        return self.keys[self.counts + self.taken >= self.threshold]


def pack(keys: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    """Sorted 32-bit keys as differences, and counts, byte planes apart, compressed."""
    planes = [np.diff(keys, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()]
    if counts is not None:
        planes.append(counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes())
    raw = b"".join(planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(blob: bytes, counted: bool) -> tuple[np.ndarray, np.ndarray | None]:
    size = int.from_bytes(blob[:8], "little")
    if not size:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    raw = np.frombuffer(pa.decompress(blob[8:], size, "zstd", asbytes=True), np.uint8).reshape(8 if counted else 4, -1)
    keys = np.cumsum(np.ascontiguousarray(raw[:4].T).view(np.uint32).ravel(), dtype=np.uint32)
    return keys, np.ascontiguousarray(raw[4:].T).view(np.uint32).ravel().astype(np.int64) if counted else None


class BitMap:
    """Which of 2**log hash prefixes a survivor has."""

    def __init__(self, log: int, bits: np.ndarray):
        self.log, self.bits = log, bits

    def knows(self, hashed: np.ndarray) -> np.ndarray:
        at = hashed >> np.uint64(64 - self.log)
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)


def each_step(batches: Iterator[pa.RecordBatch]) -> Iterator[Step]:
    """Steps over batches of (lang, text)."""
    for batch in batches:
        texts = W.Texts.of(batch.column(1))
        for part, inside, first in W.windows(texts, not_separators, STEP):
            yield Step(part, inside, batch.column(0).slice(first, part.rows))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang and the number of words, for each batch."""
    for batch in batches:
        counted = np.zeros(batch.num_rows, np.int64)
        texts = W.Texts.of(batch.column(1))
        for part, inside, first in W.windows(texts, not_separators, STEP):
            found = W.words(part, inside & (part.data != 0x20) & (part.data != 0x09))
            counted[first:first + part.rows] += np.bincount(found.row, minlength=part.rows)
        made = pa.table({"lang": batch.column(0), "n": counted}).group_by("lang").aggregate([("n", "sum")]).rename_columns(["lang", "n"])
        yield from made.to_batches()


SUMMED = "part bigint, head boolean, mass bigint, counts binary"


def deal(log: int, sizes: range, short: BitMap | None):
    """A function from texts to counted phrases of ``sizes`` words by hash partition, each with a head row that says how many
    occurrences follow. The 32 bits behind the partition's ``log`` bits name a phrase."""
    def dealt(waiting: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = added(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
        waiting.clear()
        own, edges = np.unique((keys >> np.uint64(32)).astype(np.int64), return_index=True)
        rows = []
        for p, a, b in zip(own.tolist(), edges.tolist(), np.append(edges[1:], len(keys))[:len(own)].tolist(), strict=True):
            mass = int(counts[a:b].sum())
            rows += [(p, True, mass, None), (p, False, mass, pack(keys[a:b].astype(np.uint32), counts[a:b]))]
        kinds = zip(("part", "head", "mass", "counts"), (pa.int64(), pa.bool_(), pa.int64(), pa.binary()), range(4), strict=True)
        return pa.RecordBatch.from_pydict({name: pa.array([r[i] for r in rows], kind) for name, kind, i in kinds})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for step in each_step(batches):
            source = step.phrases(sizes[-1]) if short is None else step.survivors(short, most=sizes[-1])
            hashed = np.concatenate([h for m, _, h in source if m in sizes])
            waiting.append(np.unique(hashed >> np.uint64(32 - log), return_counts=True))
            if sum(len(k) for k, _ in waiting) >= GATHER:
                yield dealt(waiting)
        if waiting:
            yield dealt(waiting)
    return run


def summarise(threshold: int):
    """A function from dealt rows, each partition's heads first, to the partitions' survivors."""
    def ended(part: int, summary: Summary, waiting: list) -> pa.RecordBatch:
        merged(summary, waiting)
        keys = summary.survivors()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([len(keys)], pa.int64()), pa.array([pack(keys)], pa.binary())],
                                          ["part", "n", "keys"])

    def merged(summary: Summary, waiting: list) -> None:
        if waiting:
            summary.add(np.concatenate([k for k, _ in waiting]), np.concatenate([c for _, c in waiting]))
            waiting.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mass, summary, waiting = None, 0, None, []
        for batch in batches:
            for part, head, more, blob in zip(*(batch.column(i) for i in range(4)), strict=True):
                part = part.as_py()
                if part != now:
                    if summary is not None:
                        yield ended(now, summary, waiting)
                    now, mass, summary = part, 0, None
                if head.as_py():
                    mass += more.as_py()
                    continue
                if summary is None:
                    summary = Summary(mass, threshold)
                waiting.append(unpack(blob.as_py(), True))
                if sum(len(k) for k, _ in waiting) >= GATHER:
                    merged(summary, waiting)
        if summary is not None:
            yield ended(now, summary, waiting)
    return run


def as_bits(log: int, bits: int):
    """A function from the partitions' survivors to their places in a map of 2**bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                keys = unpack(blob, False)[0].astype(np.uint64) | np.uint64(part) << np.uint64(32)
                places = np.unique(keys >> np.uint64(32 + log - bits))
                marks = np.zeros(1 << max(bits - log, 3), np.uint8)
                marks[(places & np.uint64((1 << (bits - log)) - 1)).astype(np.int64)] = 1
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())],
                                                 ["part", "bits"])
    return run


def bit_map(texts: DataFrame, mass: int, sizes: range, threshold: int, short: BitMap | None = None) -> BitMap:
    """The survivors among phrases of ``sizes`` words; ``mass`` is no less than the number of their occurrences."""
    log = max(0, (mass // PART_MASS).bit_length())
    dealt = texts.mapInArrow(deal(log, sizes, short), SUMMED)
    ordered = dealt.repartition(1 << log, "part").sortWithinPartitions("part", F.desc("head"))
    found = keep(ordered.mapInArrow(summarise(threshold), "part bigint, n bigint, keys binary"))
    n = found.agg(F.sum("n")).first()[0] or 0
    bits = max(min((n * BITS_EACH).bit_length(), MOST_BITS.bit_length() - 1), log + 3)
    out = np.zeros(1 << bits - 3, np.uint8)
    each = 1 << bits - log - 3
    for row in found.mapInArrow(as_bits(log, bits), "part bigint, bits binary").collect():
        out[row["part"] * each:(row["part"] + 1) * each] = np.frombuffer(row["bits"], np.uint8)
    return BitMap(bits, out)


def count_known(short: BitMap, long: BitMap):
    """A function from texts to lang, phrase, its number of words and how often the texts hold it, of the phrases the maps
    know; what a task has found is added up before it leaves."""
    def summed(waiting: list[tuple]) -> pa.RecordBatch:
        hashed, sizes, counts = (np.concatenate([w[i] for w in waiting]) for i in range(3))
        _, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
        keys, totals = added(inverse, counts)
        at = pa.array(first[keys])
        languages, phrases = (pa.concat_arrays([w[i] for w in waiting]).take(at) for i in (3, 4))
        waiting.clear()
        return pa.RecordBatch.from_arrays([languages, phrases, pa.array(sizes[first[keys]]), pa.array(totals)], ["lang", "phrase", "m", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for step in each_step(batches):
            data, start, end = step.joined()
            for m, first, hashed in step.survivors(short, long):
                keys, index, counts = np.unique(hashed, return_index=True, return_counts=True)
                at = first[index]
                waiting.append((keys, np.full(len(at), m, np.int64), counts.astype(np.int64),
                                step.languages.take(pa.array(step.row[at])), W.slices(data, start[at], end[at + m - 1])))
            if sum(len(w[0]) for w in waiting) >= GATHER:
                yield summed(waiting)
        if waiting:
            yield summed(waiting)
    return run


def frequent_phrases(docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, m words and f, for every phrase of 1 to 5 words that occurs ``threshold`` times, and lang and n words.

    Pieces end at . , ; : ! ? and 0x0A to 0x0D, words at spaces and tabs; A-Z count as lower case.
    """
    texts = pick(docs, lang="lang string", body="text string").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("body", F.lit("")).alias("body"))
    totals = keep(texts.mapInArrow(count_words, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n")))
    n = totals.agg(F.sum("n")).first()[0] or 0
    short = bit_map(texts, 2 * n, range(1, 3), threshold)
    long = bit_map(texts, (MOST - 2) * n, range(3, MOST + 1), threshold, short)
    known = texts.mapInArrow(count_known(short, long), "lang string, phrase string, m bigint, n bigint")
    counted = known.groupBy("lang", "phrase", "m").agg(F.sum("n").alias("f")).where(F.col("f") >= threshold)
    return keep(counted), totals


def collocations(docs: DataFrame, threshold: int = 100, best: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``best`` collocations of two to five words.

    a is how often the phrase occurs, n the language's words, l and r how often the parts of its weakest cut occur, and the
    score floor(1000 a n / (l r)); of several cuts of the least score the first counts. A phrase that lies inside a longer
    one of the same count is left out. A null text is empty, a null lang is ``und``; repeated rows count repeatedly, other
    columns are not looked at, an empty table has no phrases. Texts of any length are read in steps that end where a piece
    does. Within some million counts of one task phrases are told apart by 64-bit hashes, else by their text.
    """
    frequent, totals = frequent_phrases(docs, threshold)
    phrases = frequent.where("m >= 2").select("lang", "phrase", F.col("f").alias("a"), "m", F.split("phrase", " ").alias("w"))
    # what lies inside a longer phrase of the same count also lies inside one that is a word longer
    parts = phrases.where("m >= 3").select("lang", "a", F.explode(F.array(
        F.array_join(F.expr("slice(w, 1, m - 1)"), " "), F.array_join(F.expr("slice(w, 2, m - 1)"), " "))).alias("phrase"))
    around = parts.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    own = phrases.join(around, ["lang", "phrase"], "left").where("longer is null or longer < a")
    cut = own.select("lang", "phrase", "a", "m", "w", F.explode(F.expr("sequence(1L, m - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("left"),
        F.array_join(F.expr("slice(w, k + 1, m - k)"), " ").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    # products may pass 64 bits: decimals of 38 digits
    wide = [f"cast({c} as decimal(19, 0))" for c in "anlr"]
    score = F.expr(f"(1000 * ({wide[0]} * {wide[1]})) div ({wide[2]} * {wide[3]})")
    scored = cut.join(totals, "lang").withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"), F.first("a").alias("a"), F.first("n").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = weakest.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    rows = rows.withColumn("dealt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "dealt").orderBy(*order))).where(F.col("rank") <= best)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= best)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
