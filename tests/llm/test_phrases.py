"""Collocations against plain Python, and the summaries' guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from freightmart.llm import phrases as P


def brute(rows, threshold, best):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c < "\x80" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, 6):
                for i in range(len(ws) - m + 1):
                    f[lang][tuple(ws[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= threshold and len(p) >= 2}
        found = []
        for p, a in often.items():
            longer = (q for q, b in often.items() if len(q) > len(p) and b >= a)
            if any(q[i:i + len(p)] == p for q in longer for i in range(len(q) - len(p) + 1)):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def made_up(seed, rows=80):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "É", "日本", "a b", "x", "y", "zz", "'q'"]
    fixed = ["x y zz the of", "the of", "日本 é x y", "of x y zz the of the"]

    def text():
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!\x0b", ""]))
        return "".join(parts)

    return [(rng.choice(["en", "de", None, "und", ""]), text() if rng.random() < 0.95 else None) for _ in range(rows)]


@pytest.mark.parametrize("seed,threshold,best", [(1, 3, 2000), (2, 5, 7), (3, 2, 40)])
def test_collocations_equal_brute_force(llm, seed, threshold, best):
    rows = made_up(seed)
    got = P.collocations(llm.createDataFrame(rows, "lang string, text string"), threshold, best).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, threshold, best)
    assert len(got) > 10


def test_small_partitions_and_steps(llm, monkeypatch):
    """Many partitions, steps of a few words, summaries that run over, and maps that let everything through."""
    rows = made_up(4)
    want = brute(rows, 4, 50)
    monkeypatch.setattr(P, "STEP", 50)
    monkeypatch.setattr(P, "GATHER", 16)
    monkeypatch.setattr(P, "PART_MASS", 300)
    docs = llm.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in P.collocations(docs, 4, 50).collect()) == want
    monkeypatch.setattr(P, "MOST_BITS", 1 << 6)
    assert sorted(tuple(r) for r in P.collocations(docs, 4, 50).collect()) == want


@pytest.mark.parametrize("threshold", [2, 10, 50])
def test_a_summary_loses_nothing_frequent(threshold):
    rng = np.random.default_rng(threshold)
    keys = (rng.zipf(1.3, 30_000) % 3000).astype(np.uint32)
    rng.shuffle(keys)
    summary = P.Summary(len(keys), threshold)
    for part in np.array_split(keys, 40):
        summary.add(*np.unique(part, return_counts=True))
        assert len(summary.keys) <= summary.counters
    values, counts = np.unique(keys, return_counts=True)
    assert summary.taken < threshold and set(values[counts >= threshold].tolist()) <= set(summary.survivors().tolist())


def test_packed_keys_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**32, 5000, dtype=np.uint32))
    counts = np.arange(1, len(keys) + 1)
    for some in (keys, keys[:1], keys[:0]):
        got = P.unpack(P.pack(some, counts[:len(some)]), True)
        assert got[0].tolist() == some.tolist() and got[1].tolist() == counts[:len(some)].tolist()
        assert P.unpack(P.pack(some), False)[0].tolist() == some.tolist()


def test_scores_beyond_64_bits(llm):
    row = llm.sql("""SELECT (1000 * (cast(a AS decimal(19, 0)) * cast(n AS decimal(19, 0)))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0))) AS s
                     FROM VALUES (90000000001L, 7000000000000003L, 100000000007L, 100000000003L) AS t(a, n, l, r)""").first()
    assert row.s == 1000 * 90000000001 * 7000000000000003 // (100000000007 * 100000000003)


def test_edges(edge_documents):
    got = P.collocations(edge_documents, 2).collect()
    assert ("en", "a b c", 3) in {(r.lang, r.phrase, r.a) for r in got}
    assert P.collocations(edge_documents.limit(0)).collect() == []
