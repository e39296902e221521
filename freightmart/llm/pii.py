"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes that adds spans.

The field is trained on the driver from a small labelled table: lines of a bounded sample of documents, whose words are
labelled by the patterns. Tasks look only at words with a digit, @ or +, the others are outside whatever their
neighbours are; runs of the rest are decoded by Viterbi, all runs of a length in one numpy step.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import pick, steps

KINDS = ("email", "ip", "card", "phone")
#: Documents that the field is trained on, at most; which ones is decided by a hash of doc_id.
SAMPLE_DOCS = 4_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ASKS = re.compile(r"[0-9@]")
_WORD, _MARK = re.compile(r"\S+"), re.compile(r"[0-9@+]")
_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and a dotted domain, found from each @ backwards: no word is read twice."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if not _ASKS.search(text):
        return out
    out["email"] = emails(text)
    out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0]) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# Labels: outside, and first and further words of each kind.
LABELS = ("O", *(f"{p}-{kind}" for kind in KINDS for p in "BI"))


def shape(word: str) -> str:
    """Letters, digits and other characters as X, x, 9 and themselves, runs of one kind told by their rough length."""
    core = word.strip("\"'.,;:!?<>[]{}#$%&*|=~`")
    out = []
    for m in re.finditer(r"[0-9]+|[a-z]+|[A-Z]+|[^\x00-\x7f]+|.", core[:64]):
        c, n = m[0][0], len(m[0])
        kind = "9" if c.isdigit() and c.isascii() else "x" if "a" <= c <= "z" else "X" if "A" <= c <= "Z" else "u" if c > "\x7f" else c
        out.append(kind + (str(n) if kind == "9" and n <= 4 else "" if n == 1 else "+") if kind in "9xXu" else kind)
    return "".join(out)


def features(word: str) -> list[str]:
    """Word-shape features of one word; two facts about numbers, since shapes do not tell them."""
    form, digits = shape(word), _DIGITS.sub("", word[:64])
    parts = word.strip(".,;!\"'").split(".")
    return [
        f"shape={form}", f"n={min(len(digits), 20)}", f"at={word.count('@')}", f"plus={word.startswith('+')}",
        f"luhn={16 <= len(digits) <= 19 and luhn(digits)}", f"quad={len(parts) == 4 and all(p.isdecimal() and len(p) < 4 and int(p) < 256 for p in parts)}",
        f"dotted={'@' in word and '.' in word.rpartition('@')[2]}", "bias",
    ]


@dataclass
class Field:
    """Weights of (feature, label) and of (label before, label)."""

    index: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray

    def scores(self, words: list[str], cache: dict[str, np.ndarray]) -> np.ndarray:
        out = np.empty((len(words), len(LABELS)))
        for i, word in enumerate(words):
            known = cache.get(word)
            if known is None:
                ids = [self.index[f] for f in features(word) if f in self.index]
                known = self.emission[ids].sum(axis=0)
                if len(cache) < 100_000:
                    cache[word] = known
            out[i] = known
        return out

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """Best labels of many runs at once: scores (runs, length, labels)."""
        runs, length, _ = scores.shape
        back = np.zeros(scores.shape, np.int64)
        best = scores[:, 0] + self.transition[0]  # the word before a run is outside
        for t in range(1, length):
            step = best[:, :, None] + self.transition[None]
            back[:, t] = step.argmax(axis=1)
            best = step.max(axis=1) + scores[:, t]
        best = best + self.transition[:, 0]  # and so is the one behind
        out = np.zeros((runs, length), np.int64)
        out[:, -1] = best.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = back[np.arange(runs), t, out[:, t]]
        return out


def runs_of(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words with a digit, @ or +; only white space without a line end stands between them."""
    out: list[list[tuple[int, int]]] = []
    for m in _WORD.finditer(text) if _ASKS.search(text) else ():
        if not _MARK.search(text, m.start(), m.end()):
            continue
        if out and not text[out[-1][-1][1]:m.start()].strip(" \t") and m.start() - out[-1][-1][1] <= 2:
            out[-1].append(m.span())
        else:
            out.append([m.span()])
    return out


class Taken:
    """Spans of one kind that do not overlap, in order, and whether one meets a place."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans, self.ends = list(spans), [b for _, b in spans]

    def meets(self, a: int, b: int) -> tuple[int, int] | None:
        i = bisect_right(self.ends, a)
        return self.spans[i] if i < len(self.spans) and self.spans[i][0] < b else None

    def add(self, a: int, b: int) -> None:
        i = bisect_right(self.ends, a)
        self.spans.insert(i, (a, b))
        self.ends.insert(i, b)


def labelled(text: str) -> list[tuple[list[str], list[int]]]:
    taken = [Taken(base_spans(text)[kind]) for kind in KINDS]
    out = []
    for run in runs_of(text):
        labels, before = [], None
        for a, b in run:
            span = next(((t.meets(a, b), k) for k, t in enumerate(taken) if t.meets(a, b)), None)
            labels.append(0 if span is None else 1 + 2 * span[1] + (span == before))
            before = span
        out.append(([text[a:b] for a, b in run], labels))
    return out


def train(rows: list[tuple[list[str], list[int]]], rounds: int = 60, rate: float = 0.3, ridge: float = 1e-3) -> Field:
    """Maximum likelihood with a ridge term by full-batch gradients; runs of a length go forward and backward together."""
    names = sorted({f for words, _ in rows for w in set(words) for f in features(w)})
    index, width = {f: i for i, f in enumerate(names)}, len(LABELS)
    field = Field(index, np.zeros((len(names), width)), np.zeros((width, width)))
    if not rows:
        return field
    by_length: dict[int, list[tuple[np.ndarray, list[int]]]] = {}
    for words, labels in rows:
        by_length.setdefault(len(words), []).append((np.array([[index[f] for f in features(w)] for w in words]), labels))
    data = [(np.stack([x for x, _ in g]), np.array([y for _, y in g])) for g in by_length.values()]
    steps_e, steps_t = np.zeros_like(field.emission), np.zeros_like(field.transition)
    for _ in range(rounds):
        g_e, g_t = -ridge * field.emission, -ridge * field.transition
        for x, y in data:
            runs, length, _ = x.shape
            s, move = field.emission[x].sum(axis=2), field.transition
            forward, backward = np.zeros((runs, length, width)), np.zeros((runs, length, width))
            forward[:, 0] = s[:, 0] + move[0]
            for t in range(1, length):
                forward[:, t] = np.logaddexp.reduce(forward[:, t - 1][:, :, None] + move[None], axis=1) + s[:, t]
            backward[:, -1] = move[:, 0]
            for t in range(length - 2, -1, -1):
                backward[:, t] = np.logaddexp.reduce(move[None] + (s[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            total = np.logaddexp.reduce(forward[:, -1] + move[:, 0], axis=1)
            gap = np.eye(width)[y] - np.exp(forward + backward - total[:, None, None])
            np.add.at(g_e, x.reshape(-1, x.shape[2]), gap.reshape(-1, 1, width) / len(rows))
            first, last = gap[:, 0].sum(axis=0), gap[:, -1].sum(axis=0)
            g_t[0] += first / len(rows)
            g_t[:, 0] += last / len(rows)
            for t in range(1, length):
                p = np.exp(forward[:, t - 1][:, :, None] + move[None] + (s[:, t] + backward[:, t])[:, None, :] - total[:, None, None])
                np.add.at(g_t, (y[:, t - 1], y[:, t]), 1 / len(rows))
                g_t -= p.sum(axis=0) / len(rows)
        steps_e += g_e**2
        steps_t += g_t**2
        field.emission += rate * g_e / (np.sqrt(steps_e) + 1e-8)
        field.transition += rate * g_t / (np.sqrt(steps_t) + 1e-8)
    return field


def fit_pii(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Field from the runs of at most ``sample_docs`` documents that have a digit or @; equal runs count once."""
    rows = (pick(docs, doc_id="doc_id bigint", text="text string").where(F.col("text").rlike("[0-9]{4}|@"))
            .select("doc_id", F.xxhash64("doc_id", "text").alias("h")).orderBy("h", "doc_id").limit(sample_docs))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1):
            found = [run for text in batch.column(1).to_pylist() for run in labelled(text or "") if len(run[0]) <= 50]
            yield pa.RecordBatch.from_pydict({"words": pa.array([w for w, _ in found], pa.list_(pa.string())),
                                              "labels": pa.array([y for _, y in found], pa.list_(pa.int32()))})

    sample = (pick(docs, doc_id="doc_id bigint", text="text string").join(F.broadcast(rows.select("doc_id").distinct()), "doc_id")
              .mapInArrow(made, "words array<string>, labels array<int>").distinct().orderBy(F.xxhash64("words", "labels")).limit(sample_docs))
    return train(sorted((list(r["words"]), list(r["labels"])) for r in sample.collect()))


def all_spans(texts: list[str], field: Field, cache: dict[str, np.ndarray]) -> tuple[list[dict], list[dict]]:
    """Base spans of each text, and the same with those the field adds where no base span lies."""
    base = [base_spans(text) for text in texts]
    both = [{kind: list(spans) for kind, spans in own.items()} for own in base]
    taken = [[*(Taken(own[kind]) for kind in KINDS), Taken([])] for own in base]
    by_length: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    for i, text in enumerate(texts):
        for run in runs_of(text):
            by_length.setdefault(len(run), []).append((i, run))
    for length, runs in by_length.items():
        for at in range(0, len(runs), max(1, 20_000 // length)):
            part = runs[at:at + max(1, 20_000 // length)]
            scores = field.scores([texts[i][a:b] for i, run in part for a, b in run], cache).reshape(len(part), length, len(LABELS))
            for (i, run), labels in zip(part, field.viterbi(scores).tolist(), strict=True):
                at_word = 0
                while at_word < length:
                    label = labels[at_word]
                    if label % 2 == 0:  # outside, or a further word without a first
                        at_word += 1
                        continue
                    end = at_word + 1
                    while end < length and labels[end] == label + 1:
                        end += 1
                    a, b = run[at_word][0], run[end - 1][1]
                    word = texts[i][a:b]
                    left, right = len(word) - len(word.lstrip("\"'(<[{=:;,.")), len(word.rstrip("\"')>]}:;,.!?#$%&*|"))
                    a, b = a + left, a + right
                    if a < b and not any(t.meets(a, b) for t in taken[i]):
                        both[i][KINDS[label // 2]].append((a, b))
                        taken[i][-1].add(a, b)
                    at_word = end
    for own in both:
        for spans in own.values():
            spans.sort()
    return base, both


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Personal data in every whole text: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are of the base spans, spans holds those the field adds too. Places are code points, the
    end is behind the last. Null and empty texts hold nothing. Rows with equal or null doc_id are rows of their own; an
    empty table gives no rows; other columns are not looked at.
    """
    field = fit_pii(docs) if field is None else field

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, np.ndarray] = {}
        for batch in steps(batches, 1):
            base, both = all_spans([t or "" for t in batch.column(1).to_pylist()], field, cache)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([len(b[kind]) for b in base], pa.int64()) for kind in KINDS),
                 pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base]), pa.array([listed(b) for b in both])],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    return pick(docs, doc_id="doc_id bigint", text="text string").mapInArrow(
        made, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def without_personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets, and n_chars counted again; other columns stay."""
    names = [c for c in docs.columns if c not in ("text", "n_chars")]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, np.ndarray] = {}
        for batch in steps(batches, len(names)):
            raw = batch.column(len(names)).to_pylist()
            _, both = all_spans([t or "" for t in raw], field, cache)
            out = []
            for text, spans in zip(raw, both, strict=True):
                parts, done = [], 0
                for a, b, kind in sorted((a, b, kind) for kind in KINDS for a, b in spans[kind]):
                    if b > done:
                        parts += [text[done:max(a, done)], f"<{kind}>"]
                        done = b
                out.append(text if text is None else "".join([*parts, text[done:]]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string())], [*names, "text"])

    kept = docs.select(*(F.col(f"`{c}`") for c in names), F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(made, fields).withColumn("n_chars", F.length("text").cast("bigint")).select(*(F.col(f"`{c}`") for c in docs.columns))
