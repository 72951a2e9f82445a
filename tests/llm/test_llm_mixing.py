import random
import re
from collections import defaultdict

from tabloom.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def level(sizes, weights, budget):
    """Shares by weight; what is above twice a source's size goes round again."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        rest = budget - sum(target[s] for s in sizes if s not in open_)
        for s in open_:
            target[s] = rest * weights[s] / sum(weights[o] for o in open_)
        above = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not above:
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
        open_ -= above
    return target


def test_mixture(spark):
    rnd = random.Random(4)
    rows = [(i, None if rnd.random() < 0.05 else " ".join(["wä"] * rnd.randrange(60)), "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "é", "Z", "", None, "tiny" if i % 9 == 0 else "c"])) for i in range(900)]
    rows += [rows[3]] * 5
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = mixing.mixture(docs).collect()
    again = mixing.mixture(docs.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = level(sizes, weights, 1.5 * sum(sizes.values()))
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60
    assert len(got) == len(rows)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)


def test_every_source_stops(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "", "y")], SCHEMA)
    got = {r["doc_id"]: r for r in mixing.mixture(docs, share=2.0).collect()}
    assert got[1]["taken"] == 4 and got[2]["taken"] == 0 and got[2]["target"] == 0.0
