import random

import pytest

from tabloom.llm import line_dedup

SCHEMA = "doc_id long, text string"


def brute(rows, least):
    """Lines in a run of at least ``least`` words that starts earlier too, by trying every pair of places."""
    rows = sorted(rows)
    lines = {k: [(p, x) for p, x in enumerate((t or "").split("\n")) if x.split()] for k, t in rows}
    places = [(k, s) for k in lines for s in range(len(lines[k]))]
    gone = {k: set() for k in lines}
    for n, (k, s) in enumerate(places):
        for j, r in places[:n]:
            m = 0
            while s + m < len(lines[k]) and r + m < len(lines[j]) and lines[k][s + m][1] == lines[j][r + m][1]:
                m += 1
            if sum(len(x.split()) for _, x in lines[k][s:s + m]) >= least:
                gone[k].update(p for p, _ in lines[k][s:s + m])
    for k in lines:  # lines without a word go between lines that go
        for (p, _), (after, _) in zip(lines[k], lines[k][1:]):
            if {p, after} <= gone[k]:
                gone[k].update(range(p, after))
    return {k: (len((t or "").split("\n")), len(gone[k]), "\n".join(x for p, x in enumerate((t or "").split("\n")) if p not in gone[k])) for k, t in rows}


@pytest.mark.parametrize("least, seed", [(6, 1), (3, 2), (10, 3)])
def test_against_all_pairs(spark, least, seed):
    rnd = random.Random(seed)
    pool = ["the common line", "x", "y y", "", "a b c d e f g", "one two three", " "] + [f"l{i} " * rnd.randrange(1, 4) for i in range(6)]
    rows = [(i, "\n".join("the common line" if rnd.random() < 0.3 else rnd.choice(pool) for _ in range(rnd.randrange(14)))) for i in range(40)]
    rows += [(100 + i, rows[i % 4][1]) for i in range(8)] + [(200, "x\n" * 40), (201, None)]
    got = line_dedup.deduplicated(spark.createDataFrame(rows, SCHEMA).repartition(4), min_words=least).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["text"]) for r in got} == brute(rows, least)


def test_passage_between_own_lines(spark):
    passage = "\n".join(f"passage line {i} with some more words in it" for i in range(7))
    rows = [(1, "own first\n" + passage + "\nown last"), (2, "second\n" + passage + "\nend"), (3, passage), (4, "passage line 3 with some more words in it\nshort")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: rows[0][1], 2: "second\nend", 3: "", 4: rows[3][1]}
