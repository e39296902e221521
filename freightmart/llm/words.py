"""Words of whole texts as numpy arrays: places, 64-bit hashes and shingles, without a Python object per word."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed in one go; longer texts are cut where a word ends.
BLOCK = 1 << 20

_TABLE = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_known: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _table(n: int, step: int, known: dict[int, np.ndarray]) -> np.ndarray:
    if len(known.get(step, ())) < n:
        full = np.full(max(n, 1 << 16), step, np.uint64)
        full[0] = 1
        known[step] = np.multiply.accumulate(full)
    return known[step][:n]


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2**64."""
    return _table(n, _STEP, _known)


def inverses(n: int) -> np.ndarray:
    """Their inverses, modulo 2**64."""
    return _table(n, pow(_STEP, -1, 2**64), _known)


def within(data: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Which bytes lie from lo to hi."""
    return (data - np.uint8(lo)) <= np.uint8(hi - lo)


def spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes separate words: space and 0x09 to 0x0D."""
    return (data == 0x20) | within(data, 0x09, 0x0D)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return data + within(data, 65, 90).view(np.uint8) * np.uint8(32)


@dataclass
class Texts:
    """UTF-8 bytes of several texts, one after the other; nulls are empty texts."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @staticmethod
    def of(column: pa.Array) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if column.null_count:
            column = column.fill_null("")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, where, data = column.buffers()
        if len(column) == 0 or data is None:
            return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
        offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        return Texts(np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0])


@dataclass
class Words:
    """Words in order: first byte, byte behind the last, row of the text."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def per_row(self, rows: int) -> np.ndarray:
        """Offsets of each row's words, rows + 1 of them."""
        return np.searchsorted(self.row, np.arange(rows + 1))


def words(texts: Texts, inside: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes that ``inside`` marks, by default of those that are not white space; none crosses two texts."""
    inside = ~spaces(texts.data) if inside is None else inside
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = texts.offsets[:-1]
    edges = edges[edges < n]
    first[edges] = inside[edges]
    edges = texts.offsets[1:]
    edges = edges[edges > 0] - 1
    last[edges] = inside[edges]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(texts.offsets, start, "right") - 1)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for each pair; the ranges are in order and do not overlap."""
    return prefix_hashes(data, start, end, [end])[0]


def prefix_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, upto: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of data[start:x] for each array of ends x in ``upto``, none beyond ``end``.

    A range's sum of table values times powers of its own places is a difference of running sums, moved to place 0.
    """
    out = [np.zeros(len(start), np.uint64) for _ in upto]
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + BLOCK, "right")))
        lo, hi = int(start[at]), int(end[to - 1])
        running = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_TABLE[data[lo:hi]] * powers(hi - lo), out=running[1:])
        first = start[at:to] - lo
        before, back = running[first], inverses(hi - lo)[first]
        for x, made in zip(upto, out, strict=True):
            made[at:to] = (running[x[at:to] - lo] - before) * back + (x[at:to] - start[at:to]).astype(np.uint64)
        at = to
    return [mix(x) for x in out]


def shingles(hashed: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and each row's offsets among them.

    A row with 1 to k - 1 words has its whole word sequence as one shingle, a row without words has none.
    """
    count = np.diff(offsets)
    made = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    ends = np.concatenate([[0], np.cumsum(made)])
    n = int(ends[-1])
    if not n:
        return np.zeros(0, np.uint64), ends
    first = np.arange(n) - np.repeat(ends[:-1], made) + np.repeat(offsets[:-1], made)
    room = np.repeat(np.minimum(count, k), made)
    out = np.zeros(n, np.uint64)
    padded = np.concatenate([hashed, np.zeros(k, np.uint64)])
    for i, weight in enumerate(powers(k + 1)[1:]):
        part = padded[first + i] * weight
        out += part if (room > i).all() else np.where(room > i, part, np.uint64(0))
    return mix(out + room.astype(np.uint64)), ends


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each row, and the offsets."""
    values = values.copy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        values[a:b].sort()
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[offsets[:-1][offsets[:-1] < len(values)]] = True
    return values[first], np.concatenate([[0], np.cumsum(first)])[offsets]


def windows(texts: Texts, inside_of: Callable[[np.ndarray], np.ndarray], size: int) -> Iterator[tuple[Texts, np.ndarray, int]]:
    """The texts in parts of about ``size`` bytes, with the marks ``inside_of`` gives their bytes and the first row of each.

    A text may go on in the next part; a cut lies where the byte before or behind it is not inside.
    """
    at, n = 0, len(texts.data)
    while at < n:
        to, marks = min(n, at + size), None
        while marks is None:
            marks = inside_of(texts.data[at:to])
            out = np.flatnonzero(~marks[size // 2:])
            if to < n and not len(out):  # one run without an end so far
                to, marks = min(n, at + 2 * (to - at)), None
            elif to < n:
                to = at + size // 2 + int(out[-1]) + 1
                marks = marks[:to - at]
        first = int(np.searchsorted(texts.offsets, at, "right")) - 1
        last = int(np.searchsorted(texts.offsets, to, "left"))
        yield Texts(texts.data[at:to], np.clip(texts.offsets[first:last + 1], at, to) - at), marks, first
        at = to


def slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The texts data[start:end] as an Arrow array."""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length)])
    places = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    body = np.ascontiguousarray(data[places])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)).cast(pa.string())
