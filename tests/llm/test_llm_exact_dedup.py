import hashlib
import random
import re

import pytest

from tabloom.llm import exact_dedup
from tabloom.llm.exact_dedup import ContentTable

SCHEMA = "doc_id long, text string"


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (key, _), text in zip(rows, norm):
        groups.setdefault(text, []).append(key)
    low = {t: min(keys, key=lambda k: (k is None, k or 0)) for t, keys in groups.items()}
    return [(key, low[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (key, _), t in zip(rows, norm)]


def corpus(n=600, seed=1):
    rnd = random.Random(seed)
    texts = ["", None, " ", "a\tb", "a b", "a  b", "a\x0bb", "a b", "hot copy"] + [f"text {i} " + "x" * rnd.randrange(200) for i in range(60)]
    return [(None if rnd.random() < 0.02 else i, "hot copy" if rnd.random() < 0.35 else rnd.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("bucket_bytes", [50, 2000, 1 << 25])
def test_groups(spark, bucket_bytes):
    rows = corpus()
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(5), bucket_bytes=bucket_bytes).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "text_sha256")) for r in got), key=key) == sorted(brute(rows), key=key)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) and all(r["doc_id"] == r["keep_id"] for r in kept)


@pytest.mark.parametrize("bucket_bytes", [50, 1 << 25])
def test_rows_that_stay(spark, bucket_bytes):
    rows = corpus()
    got = exact_dedup.deduplicated(spark.createDataFrame(rows, SCHEMA).repartition(5), bucket_bytes=bucket_bytes).collect()
    want = {(keep, sha) for _, keep, _, sha in brute(rows)}
    assert len(got) == len(want)
    assert {(r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "").encode()).hexdigest()) for r in got} == want


def test_equal_hashes_are_told_apart():
    table = ContentTable()
    assert [table.entry(7, t) for t in ("a", "b", "a", "c", "b")] == [0, 1, 0, 2, 1]
    assert [table.entry(i, str(i)) for i in range(3000)] == list(range(3, 3003))
    assert table.entry(7, "b") == 1
