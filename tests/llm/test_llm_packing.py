import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import packing
from tabloom.llm.queries import tokenizer_path

TEXTS = ["", None, "don't Stop'd 'Tis I'LL a's", "ÀÉÎ İstanbul ŒUVRE ŉa straße été ǅ ΣΑΣ", "x²½ 12,5 a_b c--d (e)",
         "<|endoftext|> <|startoftext|>x <|x|>", "　你好 ß'ß ...'...", "\x0b\x0c\x1c a\tb\n\nc \U0001f600\U0001f600 ­x", "word, word. Word! wo rd " * 5000]


def ids_of(text):
    return np.array([*Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_ids_equal_the_tokenizers():
    coder = packing.WordEncoder(tokenizer_path())
    for _ in range(2):
        for text, got in zip(TEXTS, coder.encode([t or "" for t in TEXTS])):
            assert got == ids_of(text)[:-1].tobytes()


def test_documents_come_back(spark, table):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").unionByName(table("documents").select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    rows = packing.packed(docs, tokenizer_path()).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_bin[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for key, parts in by_doc.items():
        ids = ids_of(texts[key])
        parts.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // 4096)))
        for r in parts:
            piece = ids[r["start"]:r["start"] + r["length"]]
            assert r["start"] == 4096 * r["piece"] and len(piece) == r["length"] and zlib.crc32(piece.tobytes()) == r["ids_crc32"]
    total = 0
    for places in by_bin.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
        total += at
    assert len(by_bin) <= -(-total // 4096) + 2


@pytest.mark.parametrize("room", [packing.Capacities(100, 3, 4000), packing.Capacities(100, 100, 10_000), packing.Capacities(100, 2, 9000, (1.0, 1.0, 1.0))])
def test_every_capacity_holds(room):
    rnd = np.random.default_rng(1)
    lengths = rnd.integers(1, 60, 3000)
    bins, offsets = packing.best_fit(lengths, room)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= room.tokens and len(own) <= room.documents and (own ** 2).sum() <= room.attention
        order = np.argsort(offsets[bins == b])
        assert (np.cumsum(np.r_[0, own[order]])[:-1] == offsets[bins == b][order]).all()


def test_tightest_bin_wins():
    bins, _ = packing.best_fit(np.array([60, 50, 40, 50]), packing.Capacities(100, 9, 10_000))
    assert bins[0] == bins[2] and bins[1] == bins[3]
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), packing.Capacities(100, 9, 10_000))
    assert len(packing.best_fit(np.array([], dtype=np.int64), packing.Capacities())[0]) == 0
