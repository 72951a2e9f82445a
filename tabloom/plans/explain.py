"""Shapley attributions of every row: exact ones of histogram trees, or by permutation sampling of any model."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.numbers import key_hash
from tabloom.operators.columns import q
from tabloom.plans.histograms import HistogramModel
from tabloom.session import cut_lineage

#: Numbers (rows, leaves, features of a path) that a task holds at once, about.
CELLS = 2_000_000
#: Numbers of patterns that a task keeps, and those of a part that it works on at once.
TABLES, PART = 12_000_000, 60_000


@dataclass(frozen=True)
class Paths:
    """Leaves whose paths split on equally many features: value, and per feature its interval (low, high] and share.

    The share is the part of the training rows that the feature's splits let through along the path.
    """
    value: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def leaf_paths(model: HistogramModel) -> list[Paths]:
    """All leaves of all trees, grouped by the number of features on their path; several splits on a feature are one interval."""
    by_size: dict[int, list] = {}
    for trees in model.trees:
        column, split, child, weight = (a.tolist() for a in (trees.column, trees.split, trees.child, trees.weight))
        open_ = [(root, {}) for root in range(trees.roots)]
        while open_:
            node, path = open_.pop()
            f = column[node]
            if f < 0:
                by_size.setdefault(len(path), []).append((model.factor * trees.value[node], path))
                continue
            cut = float(model.edges[f][split[node]])
            low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
            left, right = child[node], child[node] + 1
            open_.append((left, {**path, f: (low, min(high, cut), share * weight[left] / weight[node])}))
            open_.append((right, {**path, f: (max(low, cut), high, share * weight[right] / weight[node])}))
    out = []
    for size, leaves in sorted(by_size.items()):
        parts = np.array([list(p.values()) for _, p in leaves], dtype=np.float64).reshape(len(leaves), size, 3)
        out.append(Paths(np.array([v for v, _ in leaves]), np.array([list(p) for _, p in leaves], dtype=np.int64).reshape(len(leaves), size), parts[:, :, 0], parts[:, :, 1], parts[:, :, 2]))
    return out


def _gains(share: np.ndarray, inside: np.ndarray, i: int) -> np.ndarray:
    """What feature ``i`` adds on paths with ``share`` (leaves, features), for ``inside`` (rows, leaves, features) of 0 and 1.

    A leaf counts for a subset with the product of 1 or 0 (the row's value lies in the interval or
    not) over the features inside and of the share over those outside. The subsets of each size
    without feature i are summed as the coefficients of a polynomial, which is carried along the path.
    """
    size = share.shape[1]
    sums = [np.ones(inside.shape[:2])]
    for j in range(size):
        if j != i:
            one, rest = inside[:, :, j], share[None, :, j]
            sums = [s * rest if k == 0 else s * rest + before * one for k, (s, before) in enumerate(zip(sums, [None, *sums[:-1]]))] + [sums[-1] * one]
    weights = [1.0 / (size * math.comb(size - 1, k)) for k in range(size)]
    return sum(w * s for w, s in zip(weights, sums)) * (inside[:, :, i] - share[None, :, i])


@dataclass(frozen=True)
class Patterns:
    """A few leaves of as many features, with what each feature adds for every pattern of intervals that hold a row's values.

    ``bits``: per feature its cuts and, by interval between them (the last: no number, or the lowest infinity) and leaf, the
    bit of the leaf's pattern. ``adds``: per feature its leaves, where their patterns begin, and the numbers.
    """
    bits: list[tuple[int, np.ndarray, np.ndarray]]
    adds: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]


def patterns(p: Paths) -> list[Patterns]:
    """``p`` in parts of about ``PART`` numbers."""
    leaves, size = p.feature.shape
    count = 1 << size
    held = (np.arange(count)[:, None] >> np.arange(size) & 1).astype(np.float64)
    out, step = [], max(1, PART // (count * size))
    for at in range(0, leaves, step):
        part = slice(at, at + step)
        feature, low, high, share = p.feature[part], p.low[part], p.high[part], p.share[part]
        n = len(feature)
        inside = np.broadcast_to(held[:, None, :], (count, n, size))
        gains = [(_gains(share, inside, i) * p.value[None, part]).T for i in range(size)]
        bits, adds = [], []
        for f in np.unique(feature).tolist():
            leaf, i = np.nonzero(feature == f)
            cuts = np.unique(np.concatenate([low[leaf, i], high[leaf, i]]))
            cuts = cuts[np.isfinite(cuts)]
            # Interval k lies behind cut k - 1, up to cut k.
            first = np.where(np.isinf(low[leaf, i]), 0, np.searchsorted(cuts, low[leaf, i]) + 1)
            last = np.where(np.isinf(high[leaf, i]), len(cuts), np.searchsorted(cuts, high[leaf, i]))
            k = np.arange(len(cuts) + 2)[:, None]
            mine = np.zeros((len(cuts) + 2, n), dtype=np.int32)
            mine[:, leaf] = ((k >= first) & (k <= last) & (k <= len(cuts))) << i
            bits.append((f, cuts, mine))
            adds.append((f, leaf, np.arange(len(leaf)) * count, np.concatenate([gains[b][a] for a, b in zip(leaf.tolist(), i.tolist())])))
        out.append(Patterns(bits, adds))
    return out


def ready(paths: Sequence[Paths]) -> list[Paths | Patterns]:
    """Paths as patterns while those take at most ``TABLES`` numbers; the others stay as they are."""
    out, room = [], TABLES
    for p in paths:
        leaves, size = p.feature.shape
        need = leaves * size << size
        if size and need <= room:
            room -= need
            out += patterns(p)
        else:
            out.append(p)
    return out


def path_attributions(paths: Sequence[Paths | Patterns], x: np.ndarray) -> np.ndarray:
    """Exact Shapley values (rows, features) of the trees' sum, a feature outside the subset weighing both sides by their training rows."""
    phi = np.zeros(x.shape)
    for p in paths:
        if isinstance(p, Patterns):
            code = sum(mine.take(np.where(x[:, f] > -np.inf, np.searchsorted(cuts, x[:, f]), len(cuts) + 1), axis=0) for f, cuts, mine in p.bits)
            for f, leaf, start, add in p.adds:
                phi[:, f] += add.take(code.take(leaf, axis=1) + start).sum(axis=1)
            continue
        leaves, size = p.feature.shape
        if not size:
            continue
        step = max(1, CELLS // (len(x) * size * size + 1))
        for at in range(0, leaves, step):
            part = slice(at, at + step)
            value = x[:, p.feature[part]]
            inside = ((value > p.low[part]) & (value <= p.high[part])).astype(np.float64)  # rows, leaves, features
            for i in range(size):
                total = _gains(p.share[part], inside, i) * p.value[None, part]
                for f in np.unique(p.feature[part, i]):
                    phi[:, f] += total[:, p.feature[part, i] == f].sum(axis=1)
    return phi


def tree_shapley(model: HistogramModel, rows: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``*keys, feature, phi, base, prediction`` for all rows: exact, in one pass, nothing shuffled.

    ``base`` is the model's mean over its training rows as the trees have it; base and attributions
    add up to the prediction. The model's paths are what tasks receive.
    """
    paths, keys = leaf_paths(model), list(keys)
    base = model.base + float(sum((p.value * p.share.prod(axis=1)).sum() for p in paths))
    held = rows.sparkSession.sparkContext.broadcast((model, paths))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted, leaves = held.value
        leaves = ready(leaves)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                x = np.stack(part["x"].to_numpy())
                out = part.drop(columns="x")
                yield out.assign(phi=list(path_attributions(leaves, x)), prediction=fitted.predict(x))

    narrow = rows.select(*[q(k) for k in keys], vector_to_array("features").alias("x"))
    schema = narrow.select(*[q(k) for k in keys], F.col("x").alias("phi"), F.lit(0.0).alias("prediction")).schema
    named = F.arrays_zip(F.array(*[F.lit(f) for f in features]).alias("feature"), F.col("phi").alias("phi"))
    told = narrow.mapInPandas(run, schema).select(*[q(k) for k in keys], F.explode(named).alias("e"), "prediction")
    return told.select(*[q(k) for k in keys], "e.feature", "e.phi", F.lit(base).alias("base"), "prediction")


def background_rows(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """All rows of the reference set, numbered from 0 in the order of their key hash (slot, b).

    Rows are sorted in ranges; a row's number is its place in its range plus the rows before it.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(key_hash(df, keys, seed, "background").alias("h"), F.struct(*[q(k) for k in keys]).alias("k"), vector_to_array("features").alias("b"))
    dealt = cut_lineage(rows.repartitionByRange(n, "h", "k").sortWithinPartitions("h", "k")
                        .select("b", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    parts = dealt.groupBy("part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("part", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return dealt.join(F.broadcast(starts), "part").select((F.col("at") - F.col("first") + F.col("before")).alias("slot"), "b")


def shapley(model, rows: DataFrame, background: DataFrame, keys: Sequence[str], features: Sequence[str],
            permutations: int = 10, seed: int = 42) -> DataFrame:
    """``*keys, feature, phi, base, prediction`` for all rows.

    Each row walks through random feature orders (every second one reversed), swapping its
    values into a row of the background (any of them) one feature at a time. A prediction counts for the feature
    swapped in before it and against the one swapped in after it, so the attributions are a
    plain sum and add up to prediction - base exactly. All predictions come from one
    ``model.transform``; a row's contributions are combined in its task before the shuffle.
    """
    d, keys = len(features), list(keys)
    slots = background.count()
    ids = [q(k) for k in keys]
    walks = (rows.select(*ids, vector_to_array("features").alias("x"),
                         F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("walk"))
             .withColumn("slot", F.pmod(F.xxhash64(*ids, "walk", F.lit(seed)), F.lit(slots)).cast("bigint")))
    walks = walks.join(background, "slot")
    pair = F.floor(F.col("walk") / 2)
    places = F.sequence(F.lit(0), F.lit(d - 1))
    mixed = F.array_sort(F.transform(places, lambda i: F.struct(
        F.xxhash64(*ids, pair, i, F.lit(seed + 1)).alias("h"), i.alias("i"))))
    order = F.transform(mixed, lambda s: s["i"])
    order = F.when(F.col("walk") % 2 == 1, F.reverse(order)).otherwise(order)
    walks = walks.withColumn("order", order)
    walks = walks.withColumn("place", F.transform(places, lambda i: F.array_position("order", i) - 1))
    steps = walks.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    blended = F.transform(F.arrays_zip("x", "b", "place"),
                          lambda z: F.when(z["place"] < F.col("step"), z["x"]).otherwise(z["b"]))
    scored = model.transform(steps.withColumn("features", array_to_vector(blended)))
    gain = F.when(F.col("step") > 0, F.struct(F.element_at("order", F.greatest(F.col("step"), F.lit(1))).alias("i"),
                                              F.col("prediction").alias("v")))
    loss = F.when(F.col("step") < d, F.struct(F.element_at("order", F.least(F.col("step") + 1, F.lit(d))).alias("i"),
                                              (-F.col("prediction")).alias("v")))
    ends = F.when(F.col("step") == 0, F.struct(F.lit(-1).alias("i"), F.col("prediction").alias("v")))
    last = F.when(F.col("step") == d, F.struct(F.lit(-2).alias("i"), F.col("prediction").alias("v")))
    parts = (scored.select(*ids, F.explode(F.array(gain, loss, ends, last)).alias("e"))
             .filter(F.col("e").isNotNull()).groupBy(*keys, F.col("e.i").alias("i"))
             .agg((F.sum("e.v") / permutations).alias("v")))
    # d + 2 rows per key, so a list per row is short.
    wide = parts.groupBy(*keys).agg(
        F.max(F.when(F.col("i") == -1, F.col("v"))).alias("base"),
        F.max(F.when(F.col("i") == -2, F.col("v"))).alias("prediction"),
        *[F.max(F.when(F.col("i") == j, F.col("v"))).alias(f"_p{j}") for j in range(d)])
    named = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_p{j}").alias("phi"))
                      for j, f in enumerate(features)])
    return wide.select(*keys, "base", "prediction", F.explode(named).alias("e")).select(
        *keys, "e.feature", "e.phi", "base", "prediction")


def expected_value(values: DataFrame) -> float:
    return values.agg(F.avg("base")).first()[0]


def global_importance(values: DataFrame, k: int = 30) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return (values.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
            .orderBy(F.desc("mean_abs_phi"), "feature").limit(k))
