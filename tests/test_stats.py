"""Statistics against closed forms on small tables."""

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import stats as S
from tabloom.operators.stats import chi2_tail, fisher_p, mann_whitney_p, _u_at_most


def test_chi2_tail():
    assert chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-12)
    assert chi2_tail(2 * math.log(2), 2) == pytest.approx(0.5)
    assert chi2_tail(100.0, 4) == pytest.approx(math.exp(-50) * 51, rel=1e-9)
    assert chi2_tail(0.0, 3) == 1.0 and chi2_tail(5.0, 0) == 1.0


def fisher_direct(a, b, c, d):
    row, col, n = a + b, a + c, a + b + c + d
    w = {x: math.comb(row, x) * math.comb(n - row, col - x) for x in range(max(0, row + col - n), min(row, col) + 1)}
    return sum(v for v in w.values() if v <= w[a] * (1 + 1e-7)) / sum(w.values())


@pytest.mark.parametrize("cells", [(8, 2, 1, 5), (0, 5, 5, 0), (3, 3, 3, 3), (1, 9, 11, 3), (0, 0, 4, 5), (120, 80, 90, 110), (2, 0, 0, 0)])
def test_fisher(cells):
    assert fisher_p(*cells) == pytest.approx(fisher_direct(*cells), rel=1e-6)


def test_fisher_large_table_is_quick():
    assert 0.0 <= fisher_p(10**9, 10**9, 10**9, 10**9 + 10**5) <= 1.0


def test_u_counts():
    for n1, n2 in ((2, 3), (3, 3), (1, 4), (4, 5)):
        want = [0] * (n1 * n2 + 1)
        for pick in combinations(range(n1 + n2), n1):
            want[sum(pick) - n1 * (n1 - 1) // 2] += 1
        assert [_u_at_most(n1, n2, k) for k in range(-1, n1 * n2 + 1)] == [0, *(sum(want[:k + 1]) for k in range(n1 * n2 + 1))]


def test_exact_law_has_no_size_limit():
    for n1 in (1, 4, 8):
        p = [mann_whitney_p(0, n1, n2, 0) for n2 in (2499, 2500, 2501, 10**6, 10**10)]
        assert p == pytest.approx([min(1.0, 2 / math.comb(n1 + n2, n1)) for n2 in (2499, 2500, 2501, 10**6, 10**10)])
    n1, n2 = 8, 100_000
    u = n1 * n2 * 0.6
    z = (u - n1 * n2 / 2) / math.sqrt(n1 * n2 / 12 * (n1 + n2 + 1))
    assert mann_whitney_p(u, n1, n2, 0) == pytest.approx(math.erfc(z / math.sqrt(2)), rel=0.05)


def test_mann_whitney_exact_and_normal():
    assert mann_whitney_p(0, 3, 3, 0) == pytest.approx(0.1)  # the most extreme of 20 orders, both sides
    u, n1, n2 = 130.0, 20, 20
    z = (400 - u - 200 - 0.5) / math.sqrt(400 / 12 * 41)
    assert mann_whitney_p(u, n1, n2, 0.0) == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_mann_whitney_ties(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 3.0), ("c", 9.0), ("a", None)]
    df = spark.createDataFrame(rows, "t string, v double")
    r = S.mann_whitney(df, ["v"], "t", "a", "b").first()
    # pairs: (1,1)->.5 (1,3)->0, twice; (2,1)->1 (2,3)->0
    assert (r["n1"], r["n2"], r["u"], r["ties"]) == (3, 2, 2.0, 24.0)


def test_spearman_with_gaps(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 8, 200).astype(float)
    y = x + rng.normal(0, 3, 200)
    z = np.where(rng.random(200) < 0.3, np.nan, rng.normal(size=200).round(1))
    df = spark.createDataFrame([(i, float(a), float(b), None if np.isnan(c) else float(c)) for i, (a, b, c) in enumerate(zip(x, y, z))],
                               "id int, x double, y double, z double")

    def rank(v):
        return np.array([(v < t).sum() + ((v == t).sum() + 1) / 2 for t in v])

    def rho(a, b):
        keep = ~np.isnan(a) & ~np.isnan(b)
        return np.corrcoef(rank(a[keep]), rank(b[keep]))[0, 1]

    cols = {"x": x, "y": y, "z": z}
    for rows_per_bucket in (500_000, 20):
        for r in S.spearman_matrix(df, ["x", "y", "z"], ["id"], rows_per_bucket).collect():
            assert r["rho"] == pytest.approx(rho(cols[r["a"]], cols[r["b"]]))


def test_spearman_of_thirty_columns_with_gaps(spark):
    """Every column has its own gaps, so every pair has ranks of its own."""
    rng = np.random.default_rng(8)
    table = (rng.normal(size=(400, 1)) + rng.normal(size=(400, 30))).round(1)
    table[rng.random(table.shape) < 0.15] = np.nan
    table[:, 29] = np.nan
    table[:, 28] = 3.0
    names = [f"n{i}" for i in range(30)]
    rows = [(k, *[None if np.isnan(v) else float(v) for v in r]) for k, r in enumerate(table)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names))
    want = pd.DataFrame(table, columns=names).corr("spearman", min_periods=1)
    got = S.spearman_matrix(df, names, ["id"]).collect()
    assert len(got) == 900
    for r in got:
        if r["a"] == r["b"]:
            assert r["rho"] == (None if r["a"] == "n29" else 1.0)
        elif np.isnan(want.loc[r["a"], r["b"]]):
            assert r["rho"] is None
        else:
            assert r["rho"] == pytest.approx(want.loc[r["a"], r["b"]])
    empty = S.spearman_matrix(df.limit(0), ["n0", "n1"], ["id"]).collect()
    assert len(empty) == 4 and all(r["rho"] is None for r in empty)


def test_rank_lookup_splits_frequent_values(spark):
    long = spark.range(3000).select("id", F.lit("c").alias("column"), F.when(F.col("id") % 3 > 0, 1.0).otherwise(F.col("id") * 1.0).alias("value"))
    ranks = long.groupBy("column", "value").agg(F.count("*").alias("n")).withColumn("rank", F.col("value") * 2)
    out = S.rank_lookup(long, ranks, ["id"], 3000, max_broadcast=0)
    assert out.count() == 3000 and out.filter("rank IS NULL OR rank <> value * 2").isEmpty()


def test_cramers_v(spark):
    rows = [(a, b, a, "one", f"w{i}") for i, (a, b) in enumerate([("p", "u"), ("p", "v"), ("q", "u"), ("q", "v")] * 25)]
    df = spark.createDataFrame(rows, "a string, b string, same string, constant string, wide string")
    got = {(r["a"], r["b"]): r["v"] for r in S.cramers_v(df, df.columns).collect()}
    assert got["a", "b"] == 0.0 and got["a", "same"] == pytest.approx(1.0)
    assert got["a", "constant"] is None and got["constant", "constant"] == 1.0
    assert not any("wide" in k for k in got)


def test_battery(spark):
    rows = [(i, float(i % 7), i % 2 == 0, "xyz"[i % 3], "lo" if i % 4 < 2 else "hi") for i in range(80)]
    df = spark.createDataFrame(rows, "id int, v double, flag boolean, cat string, target string").drop("id")
    df = df.withColumn("none", F.lit(None).cast("double")).withColumn("when", F.current_date())
    got = {r["feature"]: r for r in S.battery(df, "target").collect()}
    assert got["v"]["test"] == "Mann-Whitney U" and got["flag"]["test"] == "Fisher exact (2x2)"
    assert got["cat"]["test"] == "Chi-square" and got["cat"]["dof"] == 2 and got["when"]["test"] == "Unsupported dtype"
    assert "none" not in got
    order = [r["p_value"] for r in S.battery(df, "target").collect()]
    assert order[-1] is None and order[:-1] == sorted(order[:-1])
    three = df.withColumn("target", F.when(F.col("v") > 5, "Missing").otherwise(F.col("target")))
    assert {r["feature"]: r["note"] for r in S.battery(three, "target").collect()}["v"] == "target not binary"
