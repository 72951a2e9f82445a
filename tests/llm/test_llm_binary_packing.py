import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tabloom.llm import binary_packing
from tabloom.llm.queries import tokenizer_path
from test_llm_packing import TEXTS, ids_of


def test_binary_lengths():
    for n in range(1, 5000):
        parts = binary_packing.binary_lengths(n, 1024)
        assert sum(parts) == n and parts == sorted(parts, reverse=True) and all(p & (p - 1) == 0 and p <= 1024 for p in parts)
        assert len(set(p for p in parts if p < 1024)) == sum(p < 1024 for p in parts)


def test_documents_come_back(spark, table):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").unionByName(table("documents").select((F.col("doc_id") + 100).alias("doc_id"), "text")).repartition(5)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = binary_packing.packed(docs, tokenizer_path(), batch_tokens=4096).collect()
    plain = binary_packing.packed(docs, tokenizer_path(), ids=False).drop("batch_id")
    assert sorted(r["ids_crc32"] for r in plain.collect()) == sorted(r["ids_crc32"] for r in rows) and "ids" not in plain.columns
    by_doc, by_bucket, by_batch = defaultdict(list), defaultdict(list), defaultdict(set)
    for r in rows:
        assert r["length"] == 1 << r["bucket"] <= 2048 and r["offset"] == 0 and len(r["ids"]) == r["length"]
        by_doc[r["doc_id"]].append(r)
        by_bucket[r["bucket"]].append(r["sequence_id"])
        by_batch[r["batch_id"]].add(r["length"])
    assert set(by_doc) == set(texts)
    for key, parts in by_doc.items():
        ids, at = ids_of(texts[key]), 0
        for r in sorted(parts, key=lambda r: r["start"]):
            piece = ids[at:at + r["length"]]
            assert r["start"] == at and r["ids"] == piece.tolist() and r["ids_crc32"] == zlib.crc32(piece.tobytes()) and r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)
    for bucket, names in by_bucket.items():
        assert sorted(names) == [(bucket << 48) + i for i in range(len(names))]
    assert all(len(v) == 1 for v in by_batch.values())


def test_odd_limit():
    with pytest.raises(ValueError):
        binary_packing.pieces(None, "", limit=1000)
