import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import bisectors


def brute(rows, dims=64, k=40, rounds=5, seed=2):
    """Nearest centroids by comparing all exact distances, in plain Python numbers."""
    kept = [(key, [math.floor(256 * float(v)) for v in x]) for key, x in rows if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    name = lambda key: hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    centroids = [x for _, x in sorted((name(key), x) for key, x in kept)[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    nearest = lambda x: min(range(len(centroids)), key=lambda c: (far(x, centroids[c]), c))
    for _ in range(rounds):
        groups = {}
        for _key, x in kept:
            groups.setdefault(nearest(x), []).append(x)
        centroids = [[sum(c) // len(c) for c in zip(*groups[i])] if i in groups else old for i, old in enumerate(centroids)]
    told = [(key, nearest(x), far(x, centroids[nearest(x)])) for key, x in kept]
    per = {}
    for _key, c, d in told:
        per[c] = per.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((key, c, d, per[c], sum(per.values()), digest[c]) for key, c, d in told), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_all_distances(table):
    vectors = table("embeddings")
    assert result(bisectors.clusters(vectors)) == brute([(r["vec_id"], r["embedding"]) for r in vectors.collect()])


ROWS = [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, -0.5]), (3, None), (4, [0.1]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [float("inf"), 0.0]), (None, [0.25, 0.0]), (None, None),
        (8, [-3e4, 2e4]), (9, [0.0, 0.0]), (10, [-0.001, 0.001]), (1, [0.75, 0.0])]


@pytest.mark.parametrize("k", [1, 3, 40])
def test_nulls_ties_and_copies(spark, k):
    vectors = spark.createDataFrame(ROWS, "vec_id long, embedding array<double>").repartition(3)
    got = bisectors.clusters(vectors, dimensions=2, count=k)
    assert result(got) == brute(ROWS, 2, k)
    wide = vectors.withColumns({c: F.lit("x") for c in ("id", "x", "v", "cluster", "distance", "n", "sums", "inertia")})
    assert result(bisectors.clusters(wide, dimensions=2, count=k)) == result(got)
    assert bisectors.clusters(vectors.limit(0), dimensions=2, count=k).count() == 0


@pytest.mark.parametrize("largest", [40, bisectors.DOUBLES * 4])
def test_tournament_in_both_number_kinds(largest):
    rnd = np.random.default_rng(3)
    planes, x = bisectors.Bisectors(rnd.integers(-largest, largest, (17, 64))), rnd.integers(-largest, largest, (3000, 64))
    want = ((x[:, None, :] - planes.centroids[None]) ** 2).sum(axis=2)
    assert (planes.nearest(x) == want.argmin(axis=1)).all()
    middle = planes.centroids[[3, 5]].sum(axis=0)[None]  # half way between two doubled centroids: the smaller number stays
    twice = bisectors.Bisectors(2 * planes.centroids[[5, 3, 5]])
    assert twice.nearest(middle)[0] == 0


def test_huge_components_stand_at_the_bound(spark):
    vectors = spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 0.0])], "vec_id long, embedding array<double>")
    assert {r["distance"] for r in bisectors.clusters(vectors, dimensions=2, count=1, rounds=0).collect()} == {0, 4 * bisectors.LARGEST ** 2}
