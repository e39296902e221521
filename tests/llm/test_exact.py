"""Exact duplicates against a dictionary of whole texts, with filters so small that they know every key."""

from collections import defaultdict

import pytest

from freightmart.llm import exact
from freightmart.llm.exact import exact_dedup, exact_duplicates, normal


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lowered(text)].append(i)
    return {k: (max((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    got = exact_duplicates(docs, **options).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == sorted(
        (str(i), str(want[lowered(t)][0]), want[lowered(t)][1]) for i, t in rows)
    kept = [r.keep_id for r in got if r.kept]
    assert len(kept) == len(want) and all(r.doc_id == r.keep_id for r in got if r.kept)
    return got


ROWS = [
    (1, "Same text"), (2, "same TEXT"), (3, "same texT"), (3, "same text"), (4, None), (5, ""), (None, "same text"),
    (6, "É"), (7, "é"), (8, "x" * 100 + "a"), (9, "x" * 100 + "b"), (10, "x" * 100 + "A"), (None, "lonely"), (None, "LONELY"),
    (11, "Y" * 300_000), (12, "y" * 300_000), (13, "short"), (14, " short"), (-3, "Minus"), (-9, "minus"),
]


@pytest.mark.parametrize("bits", [exact.FILTER_BITS, 64])
@pytest.mark.parametrize("digest_all", [True, False])
def test_groups_equal_brute_force(llm, monkeypatch, bits, digest_all):
    monkeypatch.setattr(exact, "FILTER_BITS", bits)
    check(llm, ROWS, digest_all=digest_all)


def test_hot_group_and_shared_beginnings(llm, monkeypatch):
    rows = [(i, "copy of one text") for i in range(400)] + [(1000 + i, "a" * 80 + f"{i % 37:03d}") for i in range(300)]
    monkeypatch.setattr(exact, "HOT_PARTS", 4)
    check(llm, rows)


def test_whole_texts_are_hashed_only_for_survivors(llm):
    got = {r.doc_id: r.digest for r in check(llm, [(1, "a"), (2, "bb"), (3, "cc"), (4, "CC")])}
    assert got[1] is None and got[2] is None and got[3] == got[4] is not None


def test_lower_case_is_ascii_only(llm):
    row = llm.createDataFrame([("AZ az ÀÉ İ ẞ",)], "t string").select(normal("t").alias("t")).first()
    assert row.t == "az az ÀÉ İ ẞ"


def test_edges(edge_documents):
    got = exact_dedup(edge_documents).collect()
    assert len(got) == edge_documents.count()
    empty = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got if r.text_sha256.startswith("e3b0c442")}
    assert empty == {1: (2, 2, False), 2: (2, 2, True)}
    abc = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got if r.keep_id == 5)
    assert abc == [(-8, 5, 3, False), (5, 5, 3, False), (5, 5, 3, True)]
    assert exact_dedup(edge_documents.limit(0)).collect() == []


def test_no_python_in_the_plan(llm):
    docs = llm.createDataFrame(ROWS, "doc_id bigint, text string")
    plan = exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
