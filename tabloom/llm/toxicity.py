"""Toxicity classifier with a penalty on score changes under swapped identity terms."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import in_batches, saved, whole

#: Labelled documents that a classifier is fitted on, at most; the fit is the only bounded part.
SAMPLE_DOCS = 10_000
#: Features that the model keeps, by how well they tell the classes apart in the sample.
FEATURES = 2_000
#: Beginnings of words (in UTF-8 bytes) that are features beside the words, for word families.
PREFIXES = (4, 5, 6)
#: Weight of the counterfactual penalty against the likelihood.
PENALTY = 1.0
#: Documents of the sample that a feature needs; ALL counts the documents themselves.
MIN_DOCS, ALL = 5, -1
FOLDS = 5
CACHE_WORDS = 300_000

#: Neutral mentions of groups; a sentence keeps its meaning for the label when one replaces another.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "citizens"), ("old", "young"), ("disabled", "blind", "deaf"),
)

#: A-Z are lowered, other ASCII but digits and letters becomes a space, bytes of other characters stay.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed features of a word: the word, and its beginnings if it is longer."""
    digest = xxhash.xxh64_intdigest
    return (digest(word, 0) >> 1, *(digest(word[:n], n) >> 1 for n in PREFIXES if len(word) > n))


def text_features(found: set[bytes]) -> set[int]:
    return {f for w in found for f in word_features(w)}


def swaps(found: set[bytes], groups: tuple[tuple[str, ...], ...]) -> list[tuple[bytes, bytes]]:
    """(term, other term of its group) for each identity term among the words."""
    return [(term.encode(), other.encode()) for group in groups for term in group if term.encode() in found for other in group if other != term]


@dataclass
class Classifier:
    """Logistic score of the hashed features present in a text."""
    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, features: set[int]) -> float:
        total = self.bias + sum(sorted(self.weights.get(f, 0.0) for f in features))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def held_out(key: str, folds: int = FOLDS) -> Column:
    """crc32 of the key as text is divisible by the number of folds (no key: as the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == 0


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, size: int) -> DataFrame:
    """(y, text) of at most ``size`` labelled documents outside the held-out fold.

    The sample is the labelled keys with the lowest hashes, so it does not depend on the order of
    rows. A key with several labels has the largest, one with several texts the smallest.
    """
    known = labels.select(F.col(key).cast("long").alias("id"), F.col(label).cast("double").alias("y")).where("y IS NOT NULL AND id IS NOT NULL").where(~held_out("id"))
    chosen = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(size)
    return docs.select(F.col(key).cast("long").alias("id"), whole(text).alias("text")).join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("text").alias("text")).select((F.col("y") > 0).cast("long").alias("y"), "text")


def telling_features(rows: DataFrame, top: int) -> list[int]:
    """The ``top`` features by log-likelihood ratio between the classes; counted on the executors."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, toxic = Counter(), Counter()
        for batch in batches:
            for y, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                have = text_features(set(words(body))) | {ALL}
                seen.update(have)
                if y:
                    toxic.update(have)
        found = list(seen)
        for at in range(0, len(found), 50_000):
            part = found[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([seen[f] for f in part], pa.int64()), pa.array([toxic[f] for f in part], pa.int64())], names=["f", "n", "a"])

    counts = saved(in_batches(rows, count, "f long, n long, a long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("a").alias("a")).where(f"n >= {MIN_DOCS} OR f = {ALL}"), "features")
    totals = counts.where(F.col("f") == ALL).first()
    if totals is None:
        return []
    total, ones = float(totals["n"]), float(totals["a"])
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    parts = [F.when(got > 0, got * F.log(got * total / (of * base))).otherwise(0.0) for got, of, base in
             ((a, n, F.lit(ones)), (n - a, n, F.lit(total - ones)), (ones - a, total - n, F.lit(ones)), (total - ones - n + a, total - n, F.lit(total - ones)))]
    best = counts.where(F.col("f") != ALL).select("f", sum(parts[1:], parts[0]).alias("ratio")).orderBy(F.desc("ratio"), "f").limit(top)
    return [r["f"] for r in best.collect()]


def training_sample(rows: DataFrame, kept: set[int], groups: tuple[tuple[str, ...], ...]) -> list[tuple]:
    """(y, features, added, removed) of each row: its kept features, and what each swap of identity terms changes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, added, removed = [], [], []
            for body in batch.column(1).to_pylist():
                found = set(words(body))
                have = text_features(found) & kept
                features.append(sorted(have))
                pairs = [(have, text_features(found - {old} | {new}) & kept) for old, new in swaps(found, groups)]
                added.append([sorted(b - a) for a, b in pairs])
                removed.append([sorted(a - b) for a, b in pairs])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(features, pa.list_(pa.int64())), pa.array(added, pa.list_(pa.list_(pa.int64()))),
                                              pa.array(removed, pa.list_(pa.list_(pa.int64())))], names=["y", "features", "added", "removed"])

    return [tuple(r) for r in in_batches(rows, run, "y long, features array<long>, added array<array<long>>, removed array<array<long>>").collect()]


class _Rows:
    """Sparse rows of 0, 1 and -1 over the kept features."""

    def __init__(self, lists: list[list[tuple[int, float]]]) -> None:
        self.row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.col = np.array([c for x in lists for c, _ in x], dtype=np.int64)
        self.val = np.array([v for x in lists for _, v in x])
        self.n = len(lists)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.val * w[self.col], minlength=self.n) if len(self.row) else np.zeros(self.n)

    def back(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.col, weights=self.val * r[self.row], minlength=size) if len(self.row) else np.zeros(size)


def fit(sample: list[tuple], kept: set[int] | None = None, penalty: float = PENALTY, steps: int = 400, ridge: float = 1e-4) -> Classifier:
    """Minimise log-loss + penalty * mean squared score change under the swaps + ridge, by Adam steps.

    Rows are put in order first, so the model does not depend on the order in which they arrive.
    Without labelled rows the score is a quarter for every text.
    """
    sample = sorted(sample, key=lambda r: (r[0], r[1]))
    ys = np.array([r[0] > 0 for r in sample], dtype=np.float64)
    bias = math.log((ys.sum() + 0.5) / (len(ys) - ys.sum() + 1.5))
    if not len(ys) or ys.min() == ys.max():
        return Classifier(bias)
    kept = np.array(sorted({f for r in sample for f in r[1]}), dtype=np.int64) if kept is None else np.array(sorted(kept), dtype=np.int64)
    place = {int(f): i for i, f in enumerate(kept)}
    x = _Rows([[(place[f], 1.0) for f in r[1] if f in place] for r in sample])
    swapped = _Rows([[(place[f], 1.0) for f in plus if f in place] + [(place[f], -1.0) for f in minus if f in place]
                     for r in sample for plus, minus in zip(r[2], r[3])])
    w, m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    w[-1] = bias
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.times(w[:-1]) + w[-1], -500, 500)))
        error = (p - ys) / len(ys)
        grad = np.r_[x.back(error, len(kept)), error.sum()]
        if swapped.n:
            grad[:-1] += 2 * penalty / swapped.n * swapped.back(swapped.times(w[:-1]), len(kept))
        grad[:-1] += 2 * ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Classifier(float(w[-1]), {int(f): float(c) for f, c in zip(kept, w[:-1]) if c})


def scorer(model: Classifier) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Scores of texts; a word's kept features are looked up once per worker while the cache lasts."""
    def run(texts: Iterator[list[str]]) -> Iterator[list[float]]:
        known: dict[bytes, tuple[int, ...]] = {}
        for part in texts:
            scores = []
            for body in part:
                if len(known) > CACHE_WORDS:
                    known.clear()
                have: set[int] = set()
                for w in set(words(body)):
                    hit = known.get(w)
                    if hit is None:
                        hit = known[w] = tuple(f for f in word_features(w) if f in model.weights)
                    if hit:
                        have.update(hit)
                scores.append(model.score(have))
            yield scores

    return run


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE_DOCS,
          groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, penalty: float = PENALTY) -> Classifier:
    rows = training_rows(docs, labels, key, text, label, sample)
    kept = {*telling_features(rows, FEATURES), *text_features({t.encode() for g in groups for t in g})}
    return fit(training_sample(rows, kept, groups), kept, penalty)


def scored(docs: DataFrame, model: Classifier, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score of every whole text (0 to 1, higher: toxic likelier); nothing is shuffled.

    Null counts as the empty text, whose score is that of the bias. All columns of ``docs`` stay;
    one named like ``score`` is replaced.
    """
    kept = [c for c in docs.columns if c != score]
    place = kept.index(text)
    schema = docs.select(*kept).withColumn(score, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def texts() -> Iterator[list[str]]:
            for batch in batches:
                held.append(batch)
                yield [t or "" for t in batch.column(place).to_pylist()]

        for scores in scorer(model)(texts()):
            batch = held.pop()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, type=pa.float64())], names=[*batch.schema.names, score])

    return in_batches(docs.select(*kept), run, schema)
