"""Spelling variants: checksums, windows and near words against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from freightmart.llm import spelling as S
from freightmart.llm import words as W


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(docs, least=5, times=3):
    import re
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= times}
    near = defaultdict(list)
    for a in words:
        for b in words:
            if distance_one(a, b):
                near[a].append(b)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=str)


def made_up(seed, docs=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcéßÿ") for _ in range(rng.randint(4, 9))) for _ in range(40)]

    def word():
        w = rng.choice(base[:1 + int(40 * rng.random() ** 2)])
        at, kind = rng.randrange(len(w)), rng.random()
        if kind < 0.1:
            w = w[:at] + rng.choice("abcé") + w[at:]
        elif kind < 0.2:
            w = w[:at] + w[at + 1:]
        elif kind < 0.3:
            w = w[:at] + rng.choice("abcé") + w[at + 1:]
        return w.upper() if rng.random() < 0.1 and w.isascii() else w

    return [(i, rng.choice([" ", ", ", "-", "×", "1", " œ"]).join(word() for _ in range(rng.randint(0, 60)))) for i in range(docs)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_equal_brute_force(llm, seed):
    docs = made_up(seed) + [(None, None), (None, "abcab " * 5), (7, "abcab abcab"), (7, "abcab abcab")]
    chain = [("mnopq", 3), ("mnopr", 7), ("mnosr", 15), ("mntsr", 31), ("mutsr", 63), ("vutsr", 140)]
    docs += [(900 + i, " ".join([w] * (n // 3 + 1))) for w, n in chain for i in range(3)]
    got = S.spelling_variants(llm.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)
    assert any(r.form for r in got) and any(r.form and r.root != r.form for r in got)


def test_checksums_equal_zlib():
    rng = random.Random(5)
    runs = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 5, 9, S.LONG, S.LONG + 1, 500]))) for _ in range(200)]
    before = np.array([zlib.crc32(str(i).encode()) for i in range(200)], np.uint32)
    ends = np.cumsum([len(r) for r in runs])
    starts = ends - [len(r) for r in runs]
    got = S.checksums(np.frombuffer(b"".join(runs), np.uint8), starts, ends, before)
    assert got.tolist() == [zlib.crc32(r, int(b)) for r, b in zip(runs, before)]


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_windows_cut_no_run(size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("aé é日,") for _ in range(rng.choice([0, 3, 40, 300]))) for _ in range(30)] + ["é" * 3000, "", "a"]
    got = defaultdict(list)
    for part, inside, first in W.windows(W.Texts.of(pa.array(texts)), S.letters, size):
        found = W.words(part, inside)
        for a, b, r in zip(found.start, found.end, found.row):
            got[first + int(r)].append(part.data[a:b].tobytes().decode())
    import re
    assert dict(got) == {i: re.findall("[aé]+", t) for i, t in enumerate(texts) if re.findall("[aé]+", t)}


def test_every_pair_shares_a_signature():
    rng = random.Random(9)
    for _ in range(300):
        a = "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 12)))
        at = rng.randrange(len(a))
        same, more = a[:at] + rng.choice("xyzé") + a[at + 1:], a[:at] + rng.choice("abxé") + a[at:]
        short, long = ([set(k[i] for k in S.keys(S.latin(W.Texts.of(pa.array([a, same, more]))), longer)) for i in range(3)] for longer in (False, True))
        assert a == same or short[0] & long[1]
        assert short[0] & long[2]


def test_signatures_are_selective(llm):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice(["tion", "an", "the", "er", "in", "ou", "ble", "st"]) for _ in range(4)) for _ in range(3000)})
    df = llm.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    left, right = (df.mapInArrow(S.signed(x), "key bigint, word string, n bigint") for x in (False, True))
    candidates = left.join(right, "key").where(left["word"] != right["word"]).count()
    assert candidates < len(words) ** 2 / 20


def test_edges(edge_documents):
    got = {r.word: r.n for r in S.spelling_variants(edge_documents, every=1 << 33).collect()}
    assert len(got) == 64 and sum(got.values()) == 60_000
    assert S.spelling_variants(edge_documents.limit(0)).collect() == []
    got = S.spelling_variants(edge_documents, least=1, times=1).collect()
    assert {r.word for r in got} >= {"a", "b", "x"} and max(len(r.word) for r in got) == 80_000
