"""Nearest joins equal the full comparison, with dense spots, ties, nulls and caps."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import neighbors as NB
from tabloom.operators.neighbors import area_cap, nearest_capped


def brute(left, right, caps):
    out = {}
    for row in left.itertuples():
        if np.isnan(row.lat):
            out[row.id] = None
            continue
        d = np.sqrt((right.rlat - row.lat) ** 2 + (right.rlng - row.lng) ** 2)
        i = np.lexsort((right.rid, d))[0]
        near = np.float32(d[i] * 111.0) <= np.float32(caps.get(row.b, 1.2))
        out[row.id] = int(right.rid[i]) if near else None
    return out


@pytest.mark.parametrize("leaf, broadcast, crowd", [(32, 200_000, 100_000), (2, 0, 100_000), (4, 0, 5), (8, 40, 5)])
def test_equals_full_comparison(spark, monkeypatch, leaf, broadcast, crowd):
    monkeypatch.setattr(NB, "CROWD_ROWS", crowd)
    rng = np.random.default_rng(0)
    left = pd.DataFrame({"id": range(400), "lat": rng.normal(0, 0.02, 400).round(3), "lng": rng.normal(0, 0.02, 400).round(3),
                         "b": rng.choice(["Bronx", "Manhattan", "elsewhere"], 400)})
    left.loc[5, "lat"] = np.nan
    right = pd.DataFrame({"rid": range(300), "rlat": rng.normal(0, 0.02, 300).round(3), "rlng": rng.normal(0, 0.02, 300).round(3)})
    right.loc[:150, "rlat"] = 0.001 + rng.integers(0, 50, 151) * 1e-5  # half of the points in one spot
    right.loc[:150, "rlng"] = 0.001
    l = spark.createDataFrame(left).withColumn("lat", F.when(~F.isnan("lat"), F.col("lat")))
    out = nearest_capped(l, spark.createDataFrame(right), ("lat", "lng"), ("rlat", "rlng"), ["rid"], area_cap(F.col("b")),
                         leaf_points=leaf, max_broadcast=broadcast).select("id", "FARS__rid").collect()
    assert {r["id"]: r["FARS__rid"] for r in out} == brute(left, right, {"Bronx": 1.2, "Manhattan": 1.0})


def test_edges(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0, "a"), (2, None, 0.0, "a"), (3, 5.0, 5.0, "a"), (4, 0.0, 1.0, None)],
                                 "id int, lat double, lng double, b string")
    # two at the same distance, one duplicate place, one exactly at the cap
    right = spark.createDataFrame([(9, 0.0, 0.01), (7, 0.0, -0.01), (8, 0.0, -0.01), (5, 0.0, 1.02), (6, None, 3.0)],
                                  "rid int, rlat double, rlng double")
    cap = F.when(F.col("b").isNull(), F.lit(0.02 * 111)).otherwise(F.lit(1.2))
    out = nearest_capped(left, right, ("lat", "lng"), ("rlat", "rlng"), ["rid"], cap).collect()
    got = {r["id"]: (r["FARS__rid"], r["match_distance_km"]) for r in out}
    assert got[1][0] == 7 and got[2] == (None, None) and got[3] == (None, None)
    assert got[4][0] == 5 and abs(got[4][1] - 2.22) < 1e-5


def test_no_right_points(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lat double, lng double")
    right = spark.createDataFrame([(1, None, 0.0)], "rid int, rlat double, rlng double")
    out = nearest_capped(left, right, ("lat", "lng"), ("rlat", "rlng"), ["rid"], F.lit(1.0)).collect()
    assert len(out) == 1 and out[0]["FARS__rid"] is None


def test_points_on_a_line_and_one_place(spark):
    rng = np.random.default_rng(4)
    x = np.sort(np.concatenate([np.full(200, 0.5), rng.random(1500) ** 8]))
    right = spark.createDataFrame([(i, float(v), float(v)) for i, v in enumerate(x)], "rid int, rlat double, rlng double")
    queries = rng.random(200)
    left = spark.createDataFrame([(i, float(v), float(v)) for i, v in enumerate(queries)], "id int, lat double, lng double")
    out = nearest_capped(left, right, ("lat", "lng"), ("rlat", "rlng"), ["rid"], F.lit(1e9), leaf_points=4).collect()
    for r in out:
        v = queries[r["id"]]
        best = np.abs(x - v).min()
        assert np.isclose(abs(r["FARS__rlat"] - v), best, rtol=1e-9, atol=1e-15)


def test_odd_coordinates_match_nothing(spark):
    nan, inf = float("nan"), float("inf")
    left = spark.createDataFrame([(1, 40.0, -73.0), (2, nan, -73.0), (3, 40.0, None), (4, inf, -73.0)], "id int, y double, x double")
    right = spark.createDataFrame([(7, 40.001, -73.0), (8, nan, nan), (9, 40.0, inf)], "k int, ry double, rx double")
    got = nearest_capped(left, right, ("y", "x"), ("ry", "rx"), ["k"], F.lit(5.0)).collect()
    assert {r["id"]: r["FARS__k"] for r in got} == {1: 7, 2: None, 3: None, 4: None}


def test_crowded_key_is_dealt(spark, monkeypatch):
    """90 % of the queries at one key: its rows are copied and every pair is found once."""
    monkeypatch.setattr(NB, "CROWD_ROWS", 100)
    queries = spark.range(5_000).select(F.col("id").alias("x0"), F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("box"))
    table = spark.createDataFrame([(1, "a"), (1, "b"), (19, "c"), (29, None)], "box bigint, o string")
    out = NB.dealt_join(queries, table, ["box"], ["x0"])
    got = sorted((r["x0"], r["box"], r["o"] or "") for r in out.collect())
    assert got == sorted([*[(i, 1, o) for i in range(5_000) if i % 10 < 9 for o in "ab"], (19, 19, "c"), (29, 29, "")])
    monkeypatch.setattr(NB, "CROWDS", 2)
    assert sorted((r["x0"], r["box"], r["o"] or "") for r in NB.dealt_join(queries, table, ["box"], ["x0"]).collect()) == got
    assert NB.dealt_join(queries, table.limit(0), ["box"], ["x0"]).isEmpty()


def test_copies_lie_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(NB, "CROWD_ROWS", 100)
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        queries = spark.range(5_000).select(F.col("id").alias("x0"), F.lit(1).cast("bigint").alias("box"))
        out = NB.dealt_join(queries, spark.range(1, 2).toDF("box"), ["box"], ["x0"])
        held = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(held) == 5_000 and len(held) > 1 and max(held) < 2_000


@pytest.mark.parametrize("crowd", [100_000, 30])
def test_rows_of_one_place(spark, monkeypatch, crowd):
    """Nine of ten rows share a place, some have a null or unknown one: each row comes back once."""
    monkeypatch.setattr(NB, "CROWD_ROWS", crowd)
    left = spark.range(600).select("id", F.when(F.col("id") % 10 < 9, 0.5).when(F.col("id") % 20 == 9, F.col("id") * 1e-3).alias("lat"),
                                   F.lit(0.25).alias("lng"), F.when(F.col("id") % 2 == 0, 1.2).alias("cap"))
    right = spark.createDataFrame([(3, 0.5, 0.25), (4, 0.5, 0.251), (5, 0.409, 0.25)], "rid int, rlat double, rlng double")
    out = nearest_capped(left, right, ("lat", "lng"), ("rlat", "rlng"), ["rid"], F.col("cap"), max_broadcast=0)
    got = {r["id"]: r["FARS__rid"] for r in out.collect()}
    assert out.count() == len(got) == 600
    want = nearest_capped(left, right, ("lat", "lng"), ("rlat", "rlng"), ["rid"], F.col("cap"))
    assert got == {r["id"]: r["FARS__rid"] for r in want.collect()}
    assert got[0] == 3 and got[1] is None and got[19] is None


def test_walk_has_tasks_by_queries(spark, monkeypatch):
    monkeypatch.setattr(NB, "TASK_QUERIES", 10)
    queries = spark.range(600).select((F.col("id") * 7 % 601).cast("double").alias("x"), (F.col("id") * 11 % 599).cast("double").alias("y"))
    points = spark.range(300).select((F.col("id") * 13 % 601).cast("double").alias("x"), (F.col("id") * 5 % 599).cast("double").alias("y"), F.col("id").alias("k"))
    found = NB.nearest(queries, points, ["x", "y"], ["k"], k=3)
    assert found.rdd.getNumPartitions() >= 60
    assert found.groupBy("x", "y").count().filter("count = 3").count() == 600
