import random
import re

import numpy as np
import pytest
import xxhash

from tabloom.llm import simhash
from tabloom.llm.components import connected_components

SCHEMA = "doc_id long, text string"


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        low[find(i)] = min(key, low.get(find(i), key))
    return [(rows[i][0], f"{prints[i]:016x}", low[find(i)]) for i in range(len(rows))]


def corpus(seed=3):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice("abcdefghij") * rnd.randrange(1, 4) for _ in range(150)) for _ in range(8)]
    rows = [None, "", " ", "Two Words", "two words", "three word text"]
    for text in base:
        for _ in range(25):
            words = text.split()
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(len(words))] = "Z"
            rows.append(" ".join(words))
    rows += ["hot copy of a text"] * 40
    return list(zip(rnd.sample(range(1000), len(rows)), rows))


@pytest.mark.parametrize("group_rows", [4, 2048])
def test_against_all_pairs(spark, monkeypatch, group_rows):
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted(tuple(r) for r in simhash.near_duplicates(docs).collect()) == sorted(brute(rows))
    stay = sorted(r["doc_id"] for r in simhash.deduplicated(docs).collect())
    assert stay == sorted({c for _, _, c in brute(rows)})


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7])
def test_lanes_count_distances(radius):
    rnd = np.random.default_rng(radius)
    lanes = rnd.integers(0, 1 << 63, 150, dtype=np.uint64)
    for i in range(1, 150, 2):
        lanes[i] = lanes[i - 1] ^ np.uint64(sum(1 << int(b) for b in rnd.choice(64, rnd.integers(0, 9), replace=False)))
    words = simhash.near_lanes(simhash.bit_planes(lanes), lanes[:40], radius)
    want = np.bitwise_count(lanes[:40, None] ^ lanes[None, :]) <= radius
    got = np.zeros_like(want) if words is None else simhash._lanes(words, 150)
    assert (got == want).all()


def test_far_block_is_abandoned():
    zero, ones = np.zeros(1, dtype=np.uint64), np.full(64, ~np.uint64(0))
    assert simhash.near_lanes(simhash.bit_planes(ones), zero, 3) is None


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {n: n for e in edges for n in e}
    for _ in low:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
        if not changed:
            break
    assert got == {n: c for n, c in low.items() if n != c}
