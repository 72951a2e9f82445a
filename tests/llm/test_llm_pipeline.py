"""The pipeline's stages against plain Python on the smallest tables."""

import re
import zlib
from collections import defaultdict

import pytest

import corpus_pipeline
from conftest import DATA
from tabloom.llm import packing, toxicity
from tabloom.llm.common import saved, table
from tabloom.llm.queries import tokenizer_path
from test_llm_exact_dedup import brute as exact_brute
from test_llm_simhash import brute as simhash_brute


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, DATA, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, DATA), name)
        out.append(docs)
    return out


def test_names_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "source_mix", "best_fit_packing"]
    columns = table(spark, DATA, "documents").columns
    assert all(s.columns == columns for s in stages[:-1])


def test_filters(spark, stages):
    docs = table(spark, DATA, "documents")
    model = toxicity.train(docs, table(spark, DATA, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if model.score(toxicity.text_features(set(toxicity.words(r["text"] or "")))) < 0.5]
    kept = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert kept(stages[0]) == sorted(k for k, _ in rows)
    stay = {keep for _, keep, _, _ in exact_brute(rows)}
    assert kept(stages[1]) == sorted(stay)
    rows = [r for r in rows if r[0] in stay]
    assert kept(stages[2]) == sorted({c for _, _, c in simhash_brute(rows)})


def test_mix_and_packing(stages):
    before = {r["doc_id"]: r for r in stages[2].collect()}
    copies, words = defaultdict(int), defaultdict(int)
    for r in stages[3].collect():
        assert r == before[r["doc_id"]]
        copies[r["doc_id"]] += 1
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for k, r in before.items():
        assert copies[k] <= 2
        words["all"] += size(r["text"])
        words["taken"] += copies[k] * size(r["text"])
    assert abs(words["taken"] - 1.5 * words["all"]) < 0.05 * words["all"]
    coder, want = packing.WordEncoder(tokenizer_path()), defaultdict(int)
    for k, n in [c for c in copies.items() if c[1]]:
        ids = coder.encode([before[k]["text"] or ""])[0] + (1).to_bytes(4, "little")
        for piece, at in enumerate(range(0, len(ids), 4 * 4096)):
            want[k, piece, zlib.crc32(ids[at:at + 4 * 4096])] += n
    got, bins = defaultdict(int), defaultdict(list)
    for r in stages[4].collect():
        got[r["doc_id"], r["piece"], r["ids_crc32"]] += 1
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for places in bins.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(places[-1]) <= 4096


def test_run(spark, stages):
    key = lambda r: tuple(r)[:5]
    assert sorted(map(key, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(key, stages[-1].collect()))
