"""Personal data in words and texts without bound: linear time, and base spans as their patterns say."""

import random
import re
import time

from freightmart.llm.pii import KINDS, Taken, base_spans, labelled, luhn, runs_of


def test_one_word_of_a_megabyte():
    start = time.perf_counter()
    assert runs_of("x" * 1_000_000 + " 1") == [[(1_000_001, 1_000_002)]]
    assert labelled("y" * 1_000_000 + " a@b.cd")[0][1] == [1]
    assert time.perf_counter() - start < 2


def test_many_spans_in_one_text():
    start = time.perf_counter()
    found = labelled(" ".join(f"u{i}@example.org and" for i in range(20_000)))
    assert sum(len(y) for _, y in found) == 20_000 and time.perf_counter() - start < 10


def test_taken_places():
    taken = Taken([(3, 5), (9, 12)])
    taken.add(6, 8)
    free = [i for i in range(14) if not taken.meets(i, i + 1)]
    assert free == [0, 1, 2, 5, 8, 12, 13] and taken.spans == [(3, 5), (6, 8), (9, 12)]


def brute(text):
    """The contract's patterns as they stand."""
    out = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]}
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    out["ip"] = [m.span() for m in ips if all(int(x) <= 255 for x in m.group().split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    out["card"] = [m.span() for m in cards if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    out["phone"] = [m.span() for m in phones if 8 <= len(digits(m)) <= 15]
    return out


def test_base_spans_equal_the_patterns_on_random_texts():
    rng = random.Random(12)
    parts = ["a", "b.c", "@", ".", "-", "+", " ", "1", "25", "300", "4111111111111111", "4111 1111 1111 1111", "+7", "(", ")", "\n", "é", "x@y.zz", "10.0.0.1", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        got = base_spans(text)
        assert {k: list(got[k]) for k in KINDS} == brute(text), text
