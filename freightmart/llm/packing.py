"""Best-fit packing by exact-complement hashing.

Only lengths decide how pieces are packed, and there are at most ``capacity`` of them: Spark counts the pieces of each
length, the driver packs the counts, and every piece finds its place from its number among the pieces of its length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import keep, pick, steps
from .parts import ENCODE_BYTES, PartEncoder

CAPACITY = 2048

# A space before another white space, or at the end: there the pieces of byte-level BPE do not simply start at the space.
_RUN = (r" (?:[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}"
        r"\x{3000}\x{feff}]|\z)")


_encoders: dict[str, PartEncoder] = {}


def encoder(path: str) -> PartEncoder:
    """Byte-level BPE starts a piece at every space that a visible character follows, and encodes pieces on their own."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core
    if path not in _encoders:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        # byte-level BPE writes each byte of a piece as one character
        sizes = np.array([len(tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size())], np.int64)
        _encoders[path] = PartEncoder(tokenizer, _RUN, special, sizes=sizes)
    return _encoders[path]


def vocabulary() -> str:
    """Where the executors' own installation has the byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece: all but the first are full."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity
    return [(0, first)] * bool(first) + [(at, capacity) for at in range(first, total, capacity)]


@dataclass
class Plan:
    """Slots: for ranks ``first`` and on among the pieces of a length, sequence and place of the first."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    bins: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = np.int64(1) << 44
        at = np.searchsorted(self.length * width + self.first, length * width + rank, "right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``counts[length]`` pieces of each length.

    From the longest length down, gaps are filled exactly by a single, a pair or a triple of the lengths still there,
    as often as the counts allow; what stays goes, longest first, into the smallest gap that holds it.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    patterns: list[tuple[list[int], int]] = []

    def take(lengths: list[int]) -> int:
        kinds, uses = np.unique(lengths, return_counts=True)
        n = int((left[kinds] // uses).min())
        if n:
            left[kinds] -= n * uses
            patterns.append((lengths, n))
        return n

    def pairs(gap: int) -> np.ndarray:
        """Larger halves of the pairs that fill the gap and are there, longest first."""
        b = np.arange(gap - 1, (gap + 1) // 2 - 1, -1)
        return b[(left[b] > 0) & (left[gap - b] > 0)]

    for a in range(capacity, 0, -1):
        gap = capacity - a
        if not left[a]:
            continue
        if gap == 0:
            take([a])
            continue
        take([a, gap])
        for b in pairs(gap) if left[a] and gap > 1 else ():
            if not left[a]:
                break
            take([a, int(b), gap - int(b)])
        for b in range(min(a, gap - 2), (gap + 2) // 3 - 1, -1) if left[a] and gap > 2 else ():
            if not left[a]:
                break
            if left[b]:
                for c in pairs(gap - b):
                    if not left[a] or not left[b]:
                        break
                    if c <= b:
                        take([a, b, int(c), gap - b - int(c)])

    # best fit of the rest: bins with equal content are one entry, by gap
    gaps: dict[int, list[list]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fitting = [g for g, entries in gaps.items() if g >= length and entries]
            if not fitting:
                each = capacity // length
                for size, bins in ((each, n // each), (n % each, 1)):
                    if size and bins:
                        gaps.setdefault(capacity - size * length, []).append([[length] * size, bins])
                break
            gap = min(fitting)
            content, bins = gaps[gap].pop()
            used = min(n, bins)
            if used < bins:
                gaps[gap].append([content, bins - used])
            gaps.setdefault(gap - length, []).append([[*content, length], used])
            n -= used
    patterns += [(content, bins) for entries in gaps.values() for content, bins in entries]

    slots, base, used_up = [], 0, np.zeros(capacity + 1, np.int64)
    for lengths, n in patterns:
        offset = 0
        for length in lengths:
            slots.append((length, used_up[length], base, offset))
            used_up[length] += n
            offset += length
        base += n
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    return Plan(*table.T, base)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: Callable[[], str] = vocabulary) -> DataFrame:
    """Pieces of all documents with their length and checksum, numbered among the equally long ones of their partition."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path()).encode, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in steps(batches, 1, ENCODE_BYTES):
            rows, crc = [], []
            for row, ids in enumerate(encode(batch.column(1).fill_null(""))):
                ids += b"\0\0\0\0"
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((row, i, start, length, seen[length]))
                    crc.append(zlib.crc32(ids[4 * start:4 * (start + length)]))
                    seen[length] += 1
            row, piece, start, length, rank = (pa.array(x) for x in np.array(rows, np.int64).T)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), piece.cast(pa.int32()), start, length, pa.array(crc, pa.int64()),
                 pa.array(np.full(len(rows), part, np.int32)), rank],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return pick(docs, doc_id="doc_id bigint", text="text string").mapInArrow(
        made, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint")


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, path: Callable[[], str] = vocabulary) -> DataFrame:
    """Place of every piece of every document in sequences of at most ``capacity`` tokens.

    A document is its ids and an id 0; null and empty texts are that id alone. Documents with equal or null doc_id are
    packed like any others, an empty table gives no rows, other columns are not looked at. The pieces are checkpointed:
    their numbers must stay the same when an executor is lost.
    """
    all_pieces = keep(pieces(docs, capacity, path))
    counted = all_pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    plan = pack({int(r["length"]): int(r["n"]) for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence, offset = plan.places(batch.column(3).to_numpy(), batch.column(5).to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = all_pieces.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return numbered.mapInArrow(
        placed, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
