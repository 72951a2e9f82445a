import math

"""Exact quantiles and ranks against NumPy, through every narrowing path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import ranks as R
from tabloom.operators.ranks import exact_quantiles, group_quantiles, value_ranks

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    n = 3000
    a = np.where(rng.random(n) < 0.4, 7.0, rng.lognormal(0, 3, n))  # a third and more in one value, a long tail
    b = rng.integers(0, 5, n).astype(float)
    g = np.where(rng.random(n) < 0.6, "big", rng.choice(["x", "y"], n))
    gap = rng.random(n) < 0.1
    rows = [(str(k), None if m else float(x), float(y), 2.0) for k, x, y, m in zip(g, a, b, gap)]
    return spark.createDataFrame(rows, "g string, a double, b double, c double").repartition(5).cache(), g, np.where(gap, np.nan, a), b


@pytest.mark.parametrize("bins, sort_rows", [(2048, 200_000), (4, 5), (2, 1), (64, 50)])
def test_exact_quantiles(sample, bins, sort_rows):
    df, _g, a, b = sample
    got = exact_quantiles(df, ["a", "b", "c"], PROBS, bins, sort_rows)
    assert np.allclose(got["a"], np.nanquantile(a, PROBS), rtol=1e-12)
    assert np.allclose(got["b"], np.quantile(b, PROBS))
    assert got["c"] == [2.0] * len(PROBS)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, float("nan"))], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [None]}


@pytest.mark.parametrize("rows_per_bucket", [500_000, 100])
def test_ranks_and_group_quantiles(sample, rows_per_bucket):
    df, g, a, _b = sample
    table = value_ranks(df, ["a"], ["g"], {"low": F.col("b") < 2}, rows_per_bucket).collect()
    for r in table[:: max(1, len(table) // 60)]:
        mine = a[(g == r["g"]) & ~np.isnan(a)]
        assert r["before"] == (mine < r["value"]).sum() and r["n"] == (mine == r["value"]).sum()
    assert sum(r["n"] for r in table) == (~np.isnan(a)).sum()
    for r in group_quantiles(df, ["a"], ["g"], [0.5, 0.8], rows_per_bucket).collect():
        want = np.nanquantile(a[g == r["g"]], [0.5, 0.8])
        assert np.allclose([r["q0"], r["q1"]], want, rtol=1e-12)


def test_partitioning_does_not_matter(sample):
    df = sample[0]
    assert exact_quantiles(df.repartition(1), ["a"], PROBS) == exact_quantiles(df.repartition(17), ["a"], PROBS)


@pytest.mark.parametrize("sort_rows", [1, 40, 10_000])
def test_quantiles_of_infinite_and_very_wide_values(spark, sort_rows):
    wide = [math.inf, -math.inf, math.inf, 1.7e308, -1.7e308, 0.0, 5e-324, -5e-324, 1e-300, 2e-300] + [1.0 + i / 64 for i in range(200)] + [10.0 ** -k for k in range(60)]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(wide)], "a double, b double")
    probs = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, ["a", "b"], probs, bins=16, sort_rows=sort_rows)
    rows = sorted(wide)
    for p, g in zip(probs, got["a"]):
        low = math.floor((len(rows) - 1) * p)
        a, b, share = rows[low], rows[min(low + 1, len(rows) - 1)], (len(rows) - 1) * p - low
        assert g == (a if a == b or not share else pytest.approx(a + (b - a) * share))
    assert got["b"] == pytest.approx([(len(wide) - 1) * p for p in probs])


def test_cut_or_quantiles(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (9.0,), (None,)], "v double")
    band = lambda edges, df=rows: [r["b"] for r in R.cut_or_quantiles(df, "v", edges, ["low", "mid", "high"], "b").orderBy(F.asc_nulls_last("v")).collect()]
    assert band([0.0, 2.0, 3.0, 9.0]) == ["low", "low", "low", "mid", "high", None]
    assert band([0.0, 20.0, 30.0, 9.0]) == ["low", "low", "low", "mid", "high", None]
    assert band([0.0, 5.0, 5.0, 9.0], rows.where("v > 8")) == ["low"]
    assert band([1.0, 1.0, 2.0], rows.where("v IS NULL")) == [None]
