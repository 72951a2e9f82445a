"""Document fingerprints: a homomorphic hash of the multiset of paragraphs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import bit_counts, in_batches, shingle_hashes, whole

#: Lanes of 32 bits from a cryptographic hash of the paragraph: equal sums mean equal multisets.
EQUAL_LANES = 16
#: Lanes of 32 bits to which every word run of the paragraph adds +1 or -1: near sums mean near multisets.
NEAR_LANES = 128
RUN_WORDS = 3
LOWEST = -(1 << 63)

FINGERPRINTS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


class MultisetHash:
    """Sum of the paragraphs' vectors; lanes are taken modulo 2^32.

    Sums do not depend on the order, and paragraphs are inserted or deleted by adding or
    subtracting the hash of those paragraphs alone.
    """

    __slots__ = ("equal", "near")

    def __init__(self, equal: np.ndarray, near: np.ndarray) -> None:
        self.equal, self.near = equal, near

    @classmethod
    def of(cls, paragraphs: list[str]) -> MultisetHash:
        digests = b"".join(hashlib.blake2b(p.encode(), digest_size=4 * EQUAL_LANES).digest() for p in paragraphs)
        equal = np.frombuffer(digests, dtype="<u4").reshape(-1, EQUAL_LANES).sum(axis=0, dtype=np.uint32)
        runs = np.concatenate([shingle_hashes(p, RUN_WORDS) for p in paragraphs]) if paragraphs else np.zeros(0, dtype=np.uint64)
        counts = np.concatenate([bit_counts(runs), bit_counts(_mixed(runs))])
        return cls(equal, (2 * counts - len(runs)).astype(np.uint32))

    def __add__(self, other: MultisetHash) -> MultisetHash:
        return MultisetHash(self.equal + other.equal, self.near + other.near)

    def __sub__(self, other: MultisetHash) -> MultisetHash:
        return MultisetHash(self.equal - other.equal, self.near - other.near)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, MultisetHash) and bool((self.equal == other.equal).all() and (self.near == other.near).all())

    __hash__ = None

    def hex(self) -> str:
        return (self.equal.astype("<u4").tobytes() + self.near.astype("<u4").tobytes()).hex()

    @classmethod
    def from_hex(cls, text: str) -> MultisetHash:
        raw = bytes.fromhex(text)
        return cls(np.frombuffer(raw[:4 * EQUAL_LANES], dtype="<u4").copy(), np.frombuffer(raw[4 * EQUAL_LANES:], dtype="<u4").copy())

    def likeness(self, other: MultisetHash) -> float:
        """Estimated share of word runs in common, 0 to 1; equal fingerprints give 1.

        The mean square of the lanes estimates the squared length of the multiset of word runs,
        that of the difference the squared distance: likeness is 2ab / (aa + bb).
        """
        if self == other:
            return 1.0
        a, b, d = ((v.view(np.int32).astype(np.float64) ** 2).sum() for v in (self.near, other.near, self.near - other.near))
        return float(min(1.0, max(0.0, 1.0 - d / (a + b)))) if a + b else 0.0


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Other 64 bits from each hash (the finaliser of SplitMix64)."""
    z = hashes + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def paragraphs(text: str) -> list[str]:
    return text.split("\n")


def text_hash(text: str) -> MultisetHash:
    return MultisetHash.of(paragraphs(text))


class _Document:
    """A text with the hash of the paragraphs before the replaced end, and of the others."""

    def __init__(self, key: int, text: str) -> None:
        self.key, self.n, self.text = key, len(text), text
        self.replaced = self.n // 3
        self.head = text[:self.n - self.replaced]
        self.whole = self.head.count("\n")
        parts = paragraphs(text)
        self.fixed = MultisetHash.of(parts[:self.whole])
        self.hash = self.fixed + MultisetHash.of(parts[self.whole:])

    def against(self, following: _Document) -> tuple:
        edited = self.head + following.text[:self.replaced]
        other = self.fixed + MultisetHash.of(paragraphs(edited)[self.whole:])
        return (None if self.key == LOWEST else self.key, self.n, hashlib.sha256(edited.encode()).hexdigest(), self.hash.hex(), other.hex(),
                self.hash.likeness(other), self.hash.likeness(following.hash))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in descending order; the first row of the next range follows as a guest."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])
    range_no, held = None, None
    for batch in batches:
        rows = []
        for part, guest, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            if guest and (held is None or part != range_no):
                continue
            now = _Document(key, text)
            if held is not None and part == range_no:
                rows.append(held.against(now))
            range_no, held = part, None if guest else now
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _ranges(bounds: np.ndarray, firsts: dict[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number of each row's key range; a row with a range's largest key also goes to the range before, as a guest."""
    present = sorted(firsts)
    before = {r: present[(i + 1) % len(present)] for i, r in enumerate(present)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            part = np.searchsorted(bounds, keys, side="left")
            first = np.flatnonzero(np.array([firsts.get(p) == k for p, k in zip(part.tolist(), keys.tolist())], dtype=bool))
            take = np.r_[np.arange(len(keys)), first]
            parts = np.r_[part, [before[p] for p in part[first].tolist()]].astype(np.int32)
            rows = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array((np.arange(len(take)) >= len(keys)).astype(np.int32)), *rows.columns], names=["part", "guest", "id", "text"])

    return run


def fingerprints_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likenesses.

    The edited text replaces the last floor(n/3) code points by the first as many of the next
    document in descending order of ``key`` (after the last comes the first; a single row is
    its own next; null keys come last, equal keys in order of text). Null counts as empty text.
    Other columns are not looked at; an empty table gives an empty result.

    Keys are cut into ranges at approximate quantiles. A range's largest row is sent to the range
    before it as well, so every row meets its next one in one shuffle of the texts. The edited
    fingerprint reuses the sum of the paragraphs that the edit leaves alone.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)).alias("id"), whole(text).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    bounds = np.array(sorted(set(cuts or [])), dtype=np.int64)
    number = F.size(F.filter(F.lit(bounds.tolist()).cast("array<long>"), lambda b: b < F.col("id")))
    firsts = {r["part"]: r["first"] for r in rows.groupBy(number.alias("part")).agg(F.max("id").alias("first")).collect()}
    dealt = in_batches(rows, _ranges(bounds, firsts), "part int, guest int, id long, text string")
    in_order = dealt.repartitionById(n, F.col("part")).sortWithinPartitions("part", "guest", F.desc("id"), "text")
    return in_batches(in_order, _compare, FINGERPRINTS).withColumnRenamed("doc_id", key)
