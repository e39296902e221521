import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from freightmart.llm import words as W


def plain(text: str) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \n\té日.", max_size=40)), min_size=1, max_size=8))
def test_words_and_shingles_of_any_texts(texts):
    made = W.Texts.of(pa.array(texts, pa.string()))
    found, data = W.words(made), W.lower(made.data)
    own = [[] for _ in texts]
    for a, b, row in zip(found.start, found.end, found.row, strict=True):
        own[row].append(data[a:b].tobytes().decode())
    assert own == [plain(t) for t in texts]
    hashed = W.hashes(data, found.start, found.end)
    assert len(set(zip(hashed.tolist(), sum(own, []), strict=True))) == len(set(sum(own, [])))
    values, offsets = W.distinct(*W.shingles(hashed, found.per_row(made.rows)))
    want = [len({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0 for w in own]
    assert np.diff(offsets).tolist() == want
    del values


def test_hashes_do_not_depend_on_place_or_block(monkeypatch):
    texts = ["x yy zzz", " yy", "zzz " * 50]
    def run():
        made = W.Texts.of(pa.array(texts))
        found = W.words(made)
        return W.hashes(made.data, found.start, found.end).tolist()
    whole = run()
    monkeypatch.setattr(W, "BLOCK", 7)
    assert run() == whole and whole[1] == whole[3] and whole[2] == whole[4]
