import hashlib
import random

import pytest

from tabloom.llm import fingerprint
from tabloom.llm.fingerprint import MultisetHash, text_hash

SCHEMA = "doc_id long, text string"


def test_order_insertion_and_deletion():
    parts = ["first paragraph of words", "second one here", "", "third and last paragraph", "first paragraph of words"]
    whole = MultisetHash.of(parts)
    assert whole == MultisetHash.of(parts[::-1]) and whole.hex() == MultisetHash.of(parts[2:] + parts[:2]).hex()
    assert whole == MultisetHash.of(parts[:2]) + MultisetHash.of(parts[2:])
    assert whole - MultisetHash.of([parts[0]]) == MultisetHash.of(parts[1:])
    assert whole != MultisetHash.of(parts[1:]) and whole != MultisetHash.of([*parts, ""])
    assert MultisetHash.from_hex(whole.hex()) == whole


def test_likeness_follows_common_words():
    rnd = random.Random(2)
    text = lambda n: "\n".join(" ".join(str(rnd.randrange(10 ** 6)) for _ in range(30)) for _ in range(n))
    a, b = text(40), text(40)
    half = "\n".join(a.split("\n")[:20] + b.split("\n")[20:])
    assert text_hash(a).likeness(text_hash(a)) == 1.0
    assert 0.3 < text_hash(a).likeness(text_hash(half)) < 0.75
    assert text_hash(a).likeness(text_hash(b)) < 0.3
    assert text_hash("").likeness(text_hash("x y z")) < 0.5


@pytest.mark.parametrize("n", [30_000, 65_536, 100_000])
def test_likeness_of_long_repetitive_texts(n):
    text = "again " * n
    edited = text[:2 * len(text) // 3]
    a, b = n - 2, len(edited.split()) - 2  # copies of the one word run
    assert text_hash(text).likeness(text_hash(edited)) == pytest.approx(2 * a * b / (a * a + b * b), abs=1e-3)


def brute(rows):
    order = sorted(rows, key=lambda r: r[0], reverse=True)
    out = {}
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + after[:k]
        a, b, c = text_hash(text), text_hash(edited), text_hash(after)
        out[key] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), a.likeness(b), a.likeness(c))
    return out


@pytest.mark.parametrize("count", [1, 2, 7, 300])
def test_against_direct_hashes(spark, count):
    rnd = random.Random(count)
    words = ["é", "word", "x", "\n", "\n\n", "\U0001f600", "tab\t"]
    rows = [(k, None if rnd.random() < 0.05 else " ".join(rnd.choice(words) for _ in range(rnd.randrange(120)))) for k in rnd.sample(range(-500, 5000), count)]
    got = fingerprint.fingerprints_with_next(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute(rows) and len(got) == count
