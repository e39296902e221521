"""Searches, the n-gram join and packing against brute force on small tables with ties, copies and bad rows."""

import random
import re

import numpy as np
import pytest

from freightmart.llm import forest, partenum, topk, vectors
from freightmart.llm.forest import nearest
from freightmart.llm.packing import CAPACITY, best_fit_packing, cut, pack
from freightmart.llm.components import components
from freightmart.llm.partenum import jaccard_join
from freightmart.llm.topk import exact_top_k

from .conftest import prose

BAD = [(1000, None), (1020, [None, 1.0, 0.0]), (1040, [float("nan"), 1.0, 0.0]), (1060, [float("inf"), 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (1080, [])]


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3)).round(2)
    x[50:180] = x[50]  # copies: ties go to the smaller id
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def table(llm, rows):
    return llm.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, i string, score int")


@pytest.mark.parametrize("block", [8192, 64])
def test_exact_top_k(llm, points, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", block)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block // 8)
    got = [tuple(r) for r in exact_top_k(table(llm, points + BAD)).orderBy("query_id", "rank").collect()]
    w = np.floor(64 * np.array([v for _, v in points])).astype(int)
    want = []
    for q in range(0, 400, 20):
        s = w @ w[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-s[i], i))[:20]
        want += [(q, r + 1, i, int(s[i])) for r, i in enumerate(order)]
    assert got == want
    assert exact_top_k(table(llm, BAD)).collect() == [] == exact_top_k(table(llm, [])).collect()
    assert [tuple(r) for r in exact_top_k(table(llm, [(20, [1.0]), (20, [1.0]), (7, [1.0, 2.0])])).collect()] == [(20, 1, 7, 4096)]


@pytest.mark.parametrize("block", [8192, 16])
def test_nearest_of_a_small_table_is_exact(llm, points, block, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_VECTORS", block)
    got = [tuple(r) for r in nearest(table(llm, [*points, *BAD, (2000, [0.0, 0.0, 0.0])])).orderBy("query_id", "rank").collect()]
    x = np.array([v for _, v in points])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    for q in range(0, 400, 50):
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-round(float(u[i] @ u[q]), 12), i))[:5]
        own = [r for r in got if r[0] == q]
        assert [r[2] for r in own] == order and np.allclose([r[3] for r in own], u[order] @ u[q])
    assert nearest(table(llm, BAD)).collect() == [] == nearest(table(llm, [])).collect()


@pytest.mark.parametrize("least", [1280, 0])
def test_nearest_counts_repeated_rows(llm, least, monkeypatch):
    """True repeated rows are candidates of their own; with no least number of rows the leaf selection runs on few rows."""
    monkeypatch.setattr(forest, "LEAST_ROWS", least)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 4)).round(3)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    near = [float(v) for v in x[50] * 1.001]
    rows += [(700, near)] * 3 + [(50, rows[50][1])] * 400
    got = [tuple(r) for r in nearest(table(llm, rows)).orderBy("query_id", "rank").collect()]
    assert [r[:2] for r in got] == [(q, n) for q in (*range(0, 300, 50), 700) for n in range(1, 6)]
    assert [r[2] for r in got if r[0] == 50][:3] == [700] * 3 and [r[2] for r in got if r[0] == 700] == [50] * 5


def test_forest_recall(llm):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 32))
    found = {(r[0], r[2]) for r in nearest(table(llm, [(i, row.tolist()) for i, row in enumerate(x)])).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(q, int(i)) for q in range(0, 6000, 50) for i in [j for j in np.argsort(-(u @ u[q])) if j != q][:5]}
    assert len(found & want) / len(want) >= 0.9


def test_best_takes_ties_by_id():
    assert vectors.best(np.array([1, 3, 3, 3, 2]), np.array([9, 8, 7, 6, 5]), 2).tolist() == [3, 2]


def brute(docs):
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("hot", [64, 3])
def test_jaccard_join(llm, hot, monkeypatch):
    """Copies, near copies around the threshold, chains and a passage that most documents share; with a low HOT the hot path runs."""
    monkeypatch.setattr(partenum, "HOT", hot)
    rng = random.Random(7)
    passage, base, docs = prose(rng, 60), prose(rng, 120).split(), []
    for i in range(150):
        if i % 3 == 0:
            words = list(base)
            for _ in range(i % 8):
                words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
        elif i % 3 == 1:
            words = (passage + " " + prose(rng, rng.randint(1, 60))).split()
        else:
            words = prose(rng, rng.randint(1, 12)).split() + passage.split()[: rng.randint(0, 60)]
        docs.append((i, " ".join(words)))
    chain = prose(rng, 90).split()
    docs += [(200 + i, " ".join(chain[3 * i:3 * i + 60])) for i in range(10)]
    docs += [(300, None), (301, ""), (302, docs[0][1].upper()), (303, "one two"), (304, "ONE  two")]
    rows = jaccard_join(llm.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(docs)


def test_rows_without_doc_id_link_others(llm):
    """A null-id near copy belongs to its group, and joins two documents that are linked only through it."""
    words = prose(random.Random(11), 60).split()
    text = [" ".join(words[i:i + 40]) for i in (0, 4, 8, 20)]
    docs = [(5, text[0]), (None, text[1]), (None, text[1].upper()), (9, text[2]), (None, text[3] + " last"), (None, text[3]), (None, None)]
    rows = jaccard_join(llm.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows) == [
        ("5", 36, "5"), ("9", 36, "5"), ("None", 0, "None"), ("None", 36, "5"), ("None", 36, "5"), ("None", 36, "None"), ("None", 37, "None")]


def test_cut_and_pack():
    assert cut(5, 8) == [(0, 5)] and cut(16, 8) == [(0, 8), (8, 8)] and cut(19, 8) == [(0, 3), (3, 8), (11, 8)]
    rng = random.Random(8)
    for _ in range(40):
        counts = {rng.randint(1, 16): rng.randint(1, 9) for _ in range(rng.randint(0, 10))}
        plan, bins = pack(counts, 16), {}
        for length, n in counts.items():
            sequence, offset = plan.places(np.full(n, length), np.arange(n))
            for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
                bins.setdefault(s, []).append((o, length))
        for content in bins.values():
            at = 0
            for o, length in sorted(content):
                assert o == at
                at += length
            assert at <= 16
        total = sum(k * v for k, v in counts.items())
        assert len(bins) == plan.bins and -(-total // 16) <= plan.bins <= -(-total * 3 // 32) + 1 if total else plan.bins == 0


def test_packing_of_documents(llm, edge_documents):
    import zlib

    from tokenizers import Tokenizer

    from freightmart.llm.packing import vocabulary
    rows = best_fit_packing(edge_documents).collect()
    whole = Tokenizer.from_file(vocabulary())
    for doc in edge_documents.where("doc_id in (1, 4, 6, 7)").collect():
        ids = np.array([*whole.encode(doc["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == doc["doc_id"])
        assert [r[1:3] for r in own] == cut(len(ids), CAPACITY)
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == c for _, s, n, c in own)
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for content in filled.values():
        ends = [0]
        for offset, length in sorted(content):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= CAPACITY


def test_common_passage_makes_few_pairs(llm, monkeypatch):
    """Unlinked sets that a passage makes up for more than half are not paired with each other; links among them are found."""
    checked, plain = [], partenum.verified

    def counted(pairs, docs, classes):
        checked.append(pairs.count())
        return plain(pairs, docs, classes)

    monkeypatch.setattr(partenum, "verified", counted)
    monkeypatch.setattr(partenum, "HOT", 8)
    rng = random.Random(21)
    passage = prose(rng, 80)
    docs = [(i, passage + " " + " ".join(f"u{i}x{j}" for j in range(36 + i % 3))) for i in range(120)]
    docs += [(500 + i, docs[i][1] + " end") for i in range(20)]
    rows = jaccard_join(llm.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(docs)
    assert sum(checked) <= 2 * len(docs), checked


def test_components_estimate_does_not_grow_with_rounds(llm):
    """A chain needs many rounds; the size that the planner assumes for the result is not the product of all their joins."""
    edges = llm.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")
    found = components(edges)
    assert {r["component"] for r in found.collect()} == {0}
    assert int(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 2**80
