"""Fit/apply, encoding, models, selection, tuning and attributions."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators.encode import Preprocessor, assemble, level_order
from tabloom.operators.metrics import regression_metrics
from tabloom.plans import explain as X
from tabloom.plans import features as FT
from tabloom.plans import models as M
from tabloom.plans import selection as SEL
from tabloom.plans import tuning as TU


@pytest.fixture(scope="module")
def raw(table):
    k = F.col("event_id")
    return table("events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Start_Time"), F.dayofmonth("ts").alias("d"),
        F.when(k % 5 != 0, F.col("value")).alias("Distance(mi)"), F.when(k % 7 != 0, F.col("value") / 100).alias("Precipitation(in)"),
        F.when(k % 3 != 0, F.col("value") * 2).alias("Wind_Speed(mph)"), F.col("event_type").alias("Borough"),
        F.when(k % 4 != 0, (k % 50).cast("double")).alias("Pressure(in)"), F.when(k % 6 != 0, (k % 31).cast("double")).alias("Humidity(%)"),
        F.when(k % 8 != 0, (k % 60).cast("double")).alias("FARS__DRIVER_AGE"), F.when(k % 9 != 0, (k % 37).cast("double")).alias("FARS__MAKE"),
        (k % 2).alias("Severity_bin"), F.lit("RAIN").alias("Weather_ConditionGroup"))


def by_id(df):
    return df.toPandas().sort_values("event_id").reset_index(drop=True)


def test_fit_apply(spark, raw, tmp_path):
    train, rest = raw.filter("d <= 20").drop("d"), raw.filter("d > 20").drop("d")
    model = FT.fit_features(train, FT.FeatureConfig(keys=["event_id"]))
    model.save(spark, str(tmp_path / "art"))
    loaded = FT.FeatureModel.load(spark, str(tmp_path / "art"))
    out = by_id(model.transform(rest))
    assert out.equals(by_id(loaded.transform(rest)))
    # nothing is learnt from the rows the model is applied to
    half = by_id(model.transform(rest.filter("event_id % 2 = 0")))
    assert half.equals(out[out.event_id % 2 == 0].reset_index(drop=True))
    filled = ["Wind_Speed(mph)", "Pressure(in)", "Humidity(%)", "FARS__DRIVER_AGE", "FARS__MAKE", "Precipitation_cat"]
    assert out[filled].notna().all().all()
    assert "Start_Time" not in out and set(out["Severity_bin_ord"]) == {0, 1} and set(out["Weather_ConditionGroup_ord"]) == {3}
    assert len(out) == rest.count()
    # a batch without a column and with an extra one still has the recorded schema
    odd = model.transform(rest.drop("FARS__MAKE").withColumn("extra", F.lit(1)))
    assert odd.columns == list(out.columns)


def test_level_order():
    assert level_order(["10", "2", "__MISSING__"]) == ["__MISSING__", "2", "10"]
    assert level_order(["10", "2"], lexical=True) == ["__MISSING__", "10", "2"]
    assert level_order(["b", "a"]) == ["__MISSING__", "a", "b"]


def test_preprocessor(spark):
    train = spark.createDataFrame([(1.0, 5, "a", "2", "true"), (None, 6, None, "10", "0"), (3.0, 7, "b", "none", None)],
                                  "x double, y int, c string, o string, f string")
    model = Preprocessor(["x", "y", "c", "o", "f"], ordinal={"o": None}).fit(train)
    assert model.names() == ["num_imp__x", "num_imp__f", "num_passthrough__y", "ord__o", "cat__c___MISSING__", "cat__c_a", "cat__c_b"]
    new = spark.createDataFrame([(None, None, "zzz", "77", "1"), (4.0, 1, "a", "10", "false")], train.schema)
    rows = [tuple(r) for r in model.transform(new).collect()]
    assert rows == [(2.0, 1.0, 6.0, -1, 0, 0, 0), (4.0, 0.0, 1.0, 2, 0, 1, 0)]


def test_metrics(spark):
    rows = [(1.0, -1.0), (3.0, 2.5), (2.0, 2.0)]
    got = regression_metrics(spark.createDataFrame(rows, "label double, prediction double"))
    y, p = np.array(rows).T
    shift = 2.0
    assert got["MSE"] == pytest.approx(((y - p) ** 2).mean()) and got["MAE"] == pytest.approx(np.abs(y - p).mean())
    assert got["R2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["RMSLE"] == pytest.approx(np.sqrt(((np.log1p(y + shift) - np.log1p(p + shift)) ** 2).mean()))


def test_parameters():
    forest = TU.refined_grid("RandomForestRegressor", {"n_estimators": 400, "max_depth": 4})
    assert forest["n_estimators"] == [300, 400, 500] and forest["max_depth"] == [4, 6]
    assert TU.refined_grid("XGBRegressor", {"learning_rate": 0.2})["learning_rate"] == [0.1, 0.2, 0.3]
    grid = TU.refined_grid("XGBRegressor", {"n_estimators": 400, "max_depth": 10, "learning_rate": 0.03, "subsample": 0.6, "colsample_bytree": 0.8})
    assert 11 in grid["max_depth"] and 0.015 in grid["learning_rate"] and 0.75 in grid["subsample"]
    assert TU.refined_grid("RandomForestRegressor", {"max_depth": None, "max_features": "log2"})["max_depth"] == [None, 8, 12, 16]
    draws = TU.draw_params(TU.BOOST_GRID, 40, 42)
    assert len(draws) == 40 == len({json.dumps(d) for d in draws}) and draws == TU.draw_params(TU.BOOST_GRID, 40, 42)
    assert len(TU.draw_params({"a": [1, 2]}, 40, 1)) == 2
    assert M.tree_params({"n_estimators": 5, "max_depth": None, "colsample_bytree": 1.0, "min_samples_split": 5}, True) == {
        "maxIter": 5, "maxDepth": 30, "featureSubsetStrategy": "all", "minInstancesPerNode": 3}
    with pytest.raises(ValueError):
        M.tree_params({"what": 1}, False)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(300, 3))
    y = a @ [1, -2, 0.5] + 0.1 * rng.standard_t(2, 300)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(a, y))], "k int, a double, b double, c double, label double")
    return assemble(df, ["a", "b", "c"]).cache(), a, y


def test_linear_svr_reaches_the_optimum(vectors):
    df, a, y = vectors
    for eps in (0.0, 0.2):
        model = M.LinearSvr(epsilon=eps).fit(df)
        x = np.hstack([a, np.ones((len(a), 1))])

        def loss(w):
            return 0.5 * w @ w + np.maximum(0, np.abs(y - x @ w) - eps).sum()

        w = np.array([*model.coefficients, model.intercept])
        best = loss(w)
        rng = np.random.default_rng(2)
        for scale in (0.1, 0.01, 0.003):
            assert all(loss(w + rng.normal(0, scale, 4)) >= best - 2e-3 for _ in range(300))


def test_adaboost_improves_on_one_tree(vectors):
    df, _a, _y = vectors
    error = [regression_metrics(M.AdaBoostR2(rounds=r).fit(df).transform(df))["RMSE"] for r in (1, 8)]
    assert error[1] < error[0]


def test_permutation_is_a_permutation(vectors):
    df, a, _y = vectors
    mixed = SEL.permuted(df, ["k"], [0, 2], 2, 7, rows_per_block=40).toPandas()
    for (position, _repeat), part in mixed.groupby(["position", "repeat"]):
        x = np.stack([v.toArray() for v in part["features"]])
        assert np.allclose(np.sort(x[:, position]), np.sort(a[:, position]))
        assert not np.allclose(np.sort(x[:, 0] + x[:, 1] + x[:, 2]), np.sort(a.sum(1)))
        assert len(part) == 300


def test_votes_and_groups(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(x), float(z), int(g == 0), int(g == 1), float(x > 0)) for i, (x, z, g) in
            enumerate(zip(rng.normal(size=200), rng.normal(size=200), rng.integers(0, 2, 200)))]
    df = spark.createDataFrame(rows, "k int, good double, noise double, cat__g_0 int, cat__g_1 int, label double")
    features = ["good", "noise", "cat__g_0", "cat__g_1"]
    votes = SEL.vote_table(df, features, "label", {"cat__g_0": "g", "cat__g_1": "g"}, boost={"maxIter": 4}, forest={"numTrees": 8, "maxDepth": 4}, svr_steps=6)
    table = {r["feature"]: r["Sum"] for r in votes.collect()}
    assert table["good"] == max(table.values()) >= 3
    chosen = SEL.with_whole_groups(votes.filter("feature IN ('good', 'cat__g_1')"), votes)
    assert {r["feature"] for r in chosen.collect()} == {"good", "cat__g_0", "cat__g_1"}
    metrics = SEL.stage2(df, SEL.stage2_candidates(votes, votes.filter("feature = 'good'"), ["g"]), "label", ["k"], keep_n=1, repeats=2, boost={"maxIter": 3, "maxDepth": 2})
    got = {r["feature"]: r for r in metrics.collect()}
    assert set(got) == {"good", "cat__g_0", "cat__g_1"} and got["good"]["RFE_rank"] == 1 and got["good"]["PermImp_mean"] > 0.2


def test_tuning_and_refit(vectors):
    df, _a, _y = vectors
    train, valid, test = (df.filter(F.col("k") % 3 == i) for i in range(3))
    grid = {"XGBRegressor": {"n_estimators": [2, 6], "max_depth": [2]}}
    results = TU.two_stage(train, valid, ["k"], grid, draws=2, refine=lambda _n, best: {k: [v] for k, v in best.items()})
    name, params = TU.best_model(results)
    assert name == "XGBRegressor" and params == {"n_estimators": 6, "max_depth": 2}
    model, scores = TU.refit_best(results, train, valid, test)
    assert {r["part"] for r in scores.collect()} == {"train_valid", "test"} and len(model.trees) == 6
    with pytest.raises(ValueError):
        TU.best_model(results.drop("VALID_RMSE"))


def test_shapley_adds_up(vectors):
    df, a, _y = vectors
    model = M.make_regressor("GradientBoostingRegressor", {"n_estimators": 4}).fit(df)
    background = X.background_rows(df.orderBy("k").limit(15), ["k"]).cache()
    values = X.shapley(model, df, background, ["k"], ["a", "b", "c"], permutations=4)
    pdf = values.toPandas()
    assert len(pdf) == 900
    total = pdf.groupby("k").agg(phi=("phi", "sum"), base=("base", "first"), prediction=("prediction", "first"))
    direct = model.transform(df).select("k", "prediction").toPandas().set_index("k")["prediction"]
    assert np.allclose(total.phi + total.base, total.prediction) and np.allclose(total.prediction, direct.loc[total.index])
    top = X.global_importance(values, 1).first()
    assert top["feature"] == "b"
    again = X.shapley(model, df.repartition(5), background, ["k"], ["a", "b", "c"], permutations=4).toPandas()
    merged = pdf.merge(again, on=["k", "feature"])
    assert np.allclose(merged.phi_x, merged.phi_y)
