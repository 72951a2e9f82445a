"""Imputers against direct NumPy versions, and independence from the applied rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import impute as I

N = 300
rng = np.random.default_rng(1)
X = rng.normal(size=(N, 3)).round(1)
GAP = rng.random((N, 3)) < 0.2
XG = np.where(GAP, np.nan, X)


def frame(spark, values):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(values)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double").repartition(3)


def numbers(df):
    return df.toPandas().sort_values("id")[["a", "b", "c"]].to_numpy(dtype=float)


def knn_direct(k=5):
    out = XG.copy()
    for i, c in zip(*np.where(GAP)):
        near = []
        for j in range(N):
            common = ~GAP[i] & ~GAP[j]
            if not GAP[j, c] and common.any():
                near.append((3 / common.sum() * ((XG[i, common] - XG[j, common]) ** 2).sum(), XG[j, c]))
        near = sorted(near)[:k]
        exact = [v for d, v in near if d == 0]
        if not near:
            out[i, c] = np.nanmean(XG[:, c])
        elif exact:
            out[i, c] = np.mean(exact)
        else:
            w = np.array([d ** -0.5 for d, _ in near])
            out[i, c] = (w * [v for _, v in near]).sum() / w.sum()
    return out


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_knn(spark, broadcast):
    df = frame(spark, XG)
    got = numbers(I.KnnImputer(["a", "b", "c"], max_broadcast=broadcast).fit(df).transform(df))
    assert np.allclose(got, knn_direct(), atol=1e-9)


def test_chained(spark):
    y = X.copy()
    y[:, 1] = 2 * y[:, 0] + 0.3 * y[:, 1]
    y[:, 2] = y[:, 0] - y[:, 1] + 0.2 * y[:, 2] + 5
    y[GAP] = np.nan
    df = frame(spark, y)
    model = I.ChainedImputer(["a", "b", "c"]).fit(df)
    got = numbers(model.transform(df))
    z = np.where(GAP, np.nanmedian(y, axis=0), y)
    for _ in range(model.rounds):  # the same regressions, row by row
        for j in np.argsort(GAP.sum(0), kind="stable"):
            seen = np.hstack([z[~GAP[:, j]], np.ones(((~GAP[:, j]).sum(), 1))])
            coef, intercept = I._bayes_ridge(seen.T @ seen, j, 3)
            z[GAP[:, j], j] = z[GAP[:, j]] @ coef + intercept
    assert np.allclose(got, z, atol=1e-8)
    assert np.abs(got - np.where(GAP, 0, y))[~GAP].max() < 1e-12
    few = frame(spark, y).filter("id < 20")
    assert np.allclose(numbers(model.transform(few)), got[:20])


@pytest.mark.parametrize("patterns", [1_024, 3])
def test_chain_of_many_columns(spark, monkeypatch, patterns):
    monkeypatch.setattr(I, "MOMENT_PATTERNS", patterns)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 3))
    y = np.hstack([base, base @ rng.normal(size=(3, 27)) + rng.normal(size=(400, 27)) * 0.01])
    gap = np.array([[k > 2 and i % 9 in (k % 9, k % 4) for k in range(30)] for i in range(400)])
    names = [f"c{k}" for k in range(30)]
    rows = [(i, *[None if g else float(v) for v, g in zip(row, hole)]) for i, (row, hole) in enumerate(zip(y, gap))]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    model = I.ChainedImputer(names, max_rounds=3).fit(df)
    got = np.array([[r[n] for n in names] for r in model.transform(df).orderBy("id").collect()])
    seen = np.where(gap, np.nan, y)
    z = np.where(gap, np.nanmedian(seen, axis=0), y)
    for _ in range(model.rounds):
        for j in [j for j in np.argsort(gap.sum(0), kind="stable") if gap[:, j].any()]:
            have = np.hstack([z[~gap[:, j]], np.ones(((~gap[:, j]).sum(), 1))])
            coef, intercept = I._bayes_ridge(have.T @ have, j, 30)
            z[gap[:, j], j] = z[gap[:, j]] @ coef + intercept
    assert np.allclose(got[~gap], y[~gap]) and np.allclose(got, z, atol=1e-3)
    assert np.abs(got - y)[gap].max() < 0.5 < np.abs(np.where(gap, np.nanmedian(seen, axis=0), y) - y).max()


def test_bayes_ridge_recovers_a_line():
    x = rng.normal(size=(500, 2))
    y = 3 * x[:, 0] - x[:, 1] + 2 + 0.01 * rng.normal(size=500)
    full = np.column_stack([x, y, np.ones(500)])
    coef, intercept = I._bayes_ridge(full.T @ full, 2, 3)
    assert np.allclose([*coef[:2], intercept], [3, -1, 2], atol=0.01) and coef[2] == 0


def test_group_draws(spark, table):
    events = table("events").select(
        "event_id", F.dayofmonth("ts").alias("day"), "event_type",
        F.when((F.col("event_id") % 3 != 0) & (F.col("event_type") != "error"), F.col("value")).alias("value"))

    def fill(df, **options):
        model = I.GroupDrawImputer(["value"], ["day", "event_type"], ["event_id"], **options).fit(events)
        return {r["event_id"]: r["value"] for r in model.transform(df).collect()}

    whole = fill(events)
    assert len(whole) == events.count() and None not in whole.values()
    # slices, salts and buckets change the plan, never the draw; nor does the set of rows applied to
    assert whole == fill(events.repartition(7), pool_width=3, draws_per_task=2, rows_per_bucket=50)
    some = fill(events.filter("event_id % 2 = 0"))
    assert some == {k: whole[k] for k in some}
    pool = {(r["day"], r["event_type"], r["value"]) for r in events.collect() if r["value"] is not None}
    for r in events.filter("value IS NULL AND event_type <> 'error'").collect():
        group = {v for d, t, v in pool if (d, t) == (r["day"], r["event_type"])}
        assert not group or whole[r["event_id"]] in group


def test_empty_pool_uses_nothing(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, None)], "id int, g string, v double")
    out = I.GroupDrawImputer(["v"], ["g"], ["id"]).fit(df).transform(df)
    assert [r["v"] for r in out.collect()] == [None, None]


def test_median(spark):
    df = frame(spark, XG)
    got = numbers(I.MedianImputer(["a", "b", "c"]).fit(df).transform(df))
    assert np.allclose(got, pd.DataFrame(XG).fillna(pd.DataFrame(XG).median()).to_numpy())
