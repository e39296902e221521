"""Every operator over documents: hard rows give one result each, an empty table gives none."""

import pytest

from freightmart.llm.licenses import license_scan
from freightmart.llm.packing import best_fit_packing
from freightmart.llm.partenum import jaccard_join
from freightmart.llm.pieces import piece_check, piece_decode, piece_encode
from freightmart.llm.pii import personal_data
from freightmart.llm.quality import quality_classifier
from freightmart.llm.toxicity import toxicity

OPERATORS = {
    "quality": lambda docs, labels: quality_classifier(docs, labels),
    "toxicity": lambda docs, labels: toxicity(docs, labels),
    "pii": lambda docs, labels: personal_data(docs),
    "pieces": lambda docs, labels: piece_check(docs),
    "round": lambda docs, labels: piece_decode(piece_encode(docs)),
    "jaccard": lambda docs, labels: jaccard_join(docs),
    "licenses": lambda docs, labels: license_scan(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_document(name, edge_documents, edge_labels):
    rows = OPERATORS[name](edge_documents, edge_labels).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in edge_documents.select("doc_id").collect())


@pytest.mark.parametrize("name", [*OPERATORS, "packing"])
def test_empty_table(name, edge_documents, edge_labels):
    run = OPERATORS.get(name, lambda docs, labels: best_fit_packing(docs))
    assert run(edge_documents.limit(0), edge_labels.limit(0)).collect() == []


def test_defined_results(edge_documents, edge_labels):
    links = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join(edge_documents).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 1, -8), (-8, 1, -8), (7, 1, 7)} <= links
    empty = {r["doc_id"]: r for r in personal_data(edge_documents).collect()}
    assert empty[1]["spans"] == empty[2]["spans"] == "" and empty[1]["base_sha256"] == empty[2]["base_sha256"]
    assert {r["score"] for r in quality_classifier(edge_documents, edge_labels.limit(0)).collect()} == {0.5}
    assert {r["toxic"] for r in toxicity(edge_documents, edge_labels.limit(0)).collect()} == {0}
    assert all(r["round_trip"] and r["parity"] for r in piece_check(edge_documents).collect())
    texts = sorted((str(r["doc_id"]), r["text"] or "") for r in edge_documents.select("doc_id", "text").collect())
    assert sorted((str(r["doc_id"]), r["text"]) for r in piece_decode(piece_encode(edge_documents)).collect()) == texts
