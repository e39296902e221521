"""The pipeline over the smallest table: each stage against the operator it applies, on what the stage before kept."""

from pathlib import Path

import pytest

import corpus_pipeline
from freightmart.llm.partenum import jaccard_join
from freightmart.llm.pii import base_spans

FOLDER = "/root/testdata/sf0.001"


def test_near_duplicates_decides_rows(llm):
    """Repeated doc_ids: an unlinked row stays, of repeated winners one stays, and groups of one least doc_id are apart."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    docs = [(1, a, "x"), (2, a.upper(), "x"), (2, b, "x"), (3, c, "x"), (3, c, "x"), (3, c + " more", "x"), (3, d, "x"), (4, d, "x"), (5, "", "x"), (5, None, "x"), (None, a, "x"), (6, "six", "x")]
    kept = corpus_pipeline.near_duplicates(llm, llm.createDataFrame(docs, "doc_id bigint, text string, source string"), FOLDER).collect()
    left = sorted(str((r["doc_id"], r["text"])) for r in kept if r["doc_id"] != 3)
    assert left == sorted(str(x) for x in [(1, a), (2, b), (5, ""), (5, None), (None, a), (6, "six")])
    three = [r["text"] for r in kept if r["doc_id"] == 3]
    assert len(three) == 2 and d in three and three[0][:2] != three[1][:2]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_stages(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = corpus_pipeline.keep(stage(llm, docs, FOLDER))
        assert made.columns == columns
        rows = {r["doc_id"]: r for r in made.collect()}
        assert rows.keys() <= before.keys() and len(rows) > 0.7 * len(before)
        if name == "near_duplicates":
            assert sorted(rows) == sorted({r["component_id"] for r in jaccard_join(docs).collect()})
        if name == "personal_data":
            assert rows.keys() == before.keys()
            assert not any(spans for r in rows.values() for spans in base_spans(r["text"]).values())
            assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
        else:
            assert all(before[i] == r for i, r in rows.items())
        before, docs = rows, made
    packed = corpus_pipeline.packing(llm, docs, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == before.keys()
    assert corpus_pipeline.run(llm, FOLDER).count() == len(packed)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_stages_keep_columns_with_the_names_of_their_results(llm):
    names = ["score", "predicted", "severity", "grade", "toxic", "held_out"]
    own = llm.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 40")
    docs = own.selectExpr("*", *[f"concat('{n} of ', doc_id) as {n}" for n in names])
    for stage, plain in ((corpus_pipeline.quality, "quality"), (corpus_pipeline.toxicity, "toxicity")):
        kept = stage(llm, docs, FOLDER)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names)
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)[plain](llm, own, FOLDER).collect())
        assert stage(llm, docs.limit(0), FOLDER).collect() == []
