"""Trained operators: held-out accuracy on made-up documents, and the parts of the models against plain versions."""

import itertools
import random

import numpy as np

from freightmart.llm.pii import LABELS, Field, base_spans, fit_pii, train, without_personal_data
from freightmart.llm.quality import quality_classifier
from freightmart.llm.toxicity import best_cut, toxicity
from freightmart.llm.trees import Boosted, fit

from .conftest import prose


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x, y, trees=20, depth=3)

    def walk(row):
        total = model.base
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf, strict=True):
            at = 0
            while at < len(cut):
                at = 2 * at + 1 + int(row[feature[at]] > cut[at])
            total += leaf[at - len(cut)]
        return total

    assert np.allclose(model.margin(x), [walk(r) for r in x])
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.97
    assert (fit(x[:0], y[:0]).score(x[:3]) == 0.5).all() and isinstance(model, Boosted)


def test_quality_on_held_out_documents(llm):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        docs.append((i, prose(rng, rng.randint(20, 200)) if good else " ".join([prose(rng, 1)] * rng.randint(20, 200))))
        labels.append((i, int(good)))
    rows = quality_classifier(llm.createDataFrame(docs, "doc_id bigint, text string"), llm.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held) / len(held) > 0.98


def test_toxicity_on_held_out_documents(llm):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        words, toxic = prose(rng, 60).split(), i % 4 == 0
        for _ in range(rng.randint(1, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["blarg!", "Frotz", "zorked", "zorking"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows = toxicity(llm.createDataFrame(docs, "doc_id bigint, text string"), llm.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["toxic"] == int(r["doc_id"] % 4 == 0) for r in held) / len(held) > 0.98
    clean, bad = ([r["severity"] for r in rows if (r["doc_id"] % 4 == 0) == t] for t in (False, True))
    assert np.mean(bad) > 1 > 0.2 > np.mean(clean)


def test_best_cut():
    assert 1 < best_cut(np.array([0.0, 1, 2, 3]), np.array([False, False, True, True])) < 2
    assert best_cut(np.array([0.0, 0.0]), np.array([True, True])) == float("-inf")


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(4)
    field = Field({}, np.zeros((0, len(LABELS))), rng.normal(size=(len(LABELS), len(LABELS))))
    scores = rng.normal(size=(3, 3, len(LABELS)))
    for run, got in zip(scores, field.viterbi(scores), strict=True):
        def value(path, run=run):
            around = [0, *path, 0]
            return sum(run[t, y] for t, y in enumerate(path)) + sum(field.transition[a, b] for a, b in itertools.pairwise(around))
        assert tuple(got) == max(itertools.product(range(len(LABELS)), repeat=3), key=value)


def test_field_learns_shapes():
    rows = [(["1.2.3.4"], [3]), (["17"], [0]), (["a@b.co"], [1]), (["+1", "(555)", "123-4567"], [7, 8, 8])] * 3
    field = train(rows)
    for words, labels in rows[:4]:
        scores = field.scores(words, {})[None]
        assert field.viterbi(scores)[0].tolist() == labels


def test_base_patterns():
    text = "x.y@mail1.example.com, 10.0.0.256 10.0.0.255 4111 1111 1111 1111 4111111111111112 +1 (234) 555-0199."
    found = {k: [text[a:b] for a, b in v] for k, v in base_spans(text).items()}
    assert found == {"email": ["x.y@mail1.example.com"], "ip": ["10.0.0.255"], "card": [], "phone": ["+1 (234) 555-0199"]}
    assert base_spans("card 4111-1111-1111-1111!")["card"] == [(5, 24)]
    assert base_spans("a@b a@b.c@d.e")["email"] == [(4, 9)]
    assert base_spans("")["phone"] == []


def test_redaction(llm):
    docs = llm.createDataFrame([(1, "mail a.b@c.org now", 9, "k"), (2, None, 9, None), (3, "plain", 9, "k")], "doc_id bigint, text string, n_chars bigint, lang string")
    rows = {r["doc_id"]: r for r in without_personal_data(docs, fit_pii(docs)).collect()}
    assert rows[1]["text"] == "mail <email> now" and rows[1]["n_chars"] == 16 and rows[2]["text"] is None and rows[3]["text"] == "plain"
