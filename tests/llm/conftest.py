import random

import pytest

from freightmart.llm.base import ship


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


def prose(rng: random.Random, words: int) -> str:
    stems = [a + b for a in ("ta", "mo", "re", "li", "su", "ne", "ka", "do") for b in ("rin", "lem", "sot", "vak", "dur", "pes", "gal", "nim")]
    out = [rng.choice(stems) for _ in range(words)]
    return " ".join(w.capitalize() if i % 9 == 0 else w + "." * (i % 9 == 8) for i, w in enumerate(out))


#: Names that operators use inside: a table may have columns of its own under them.
CLASHES = "id label key key2 n a b kind members slack score predicted part rank before length h i j g asks vector mask dir path license"


@pytest.fixture(scope="session")
def edge_documents(llm):
    """Null and empty texts, white space, a very long text, repeated rows, null ids, and columns with clashing names."""
    rng = random.Random(3)
    long = prose(rng, 60_000)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "a b c"), (5, "a b c"), (None, "x y z"), (6, "A B\u00e9 C 日本 🦄"), (7, "ab" * 40_000), (-8, "a b c")]
    extra = CLASHES.split()
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in extra)
    rows = [(i, t, None if i == 3 else "en", "s", None if t is None else len(t), *("x" for _ in extra)) for i, t in texts]
    return llm.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def edge_labels(llm):
    return llm.createDataFrame([(1, None, None), (2, 0, 1), (4, 1, 0), (4, 1, 0), (None, 1, 1), (5, 0, 1), (5, 1, 0)],
                               "doc_id bigint, quality int, toxic int")
