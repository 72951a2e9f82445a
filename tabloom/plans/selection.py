"""Feature selection: five model votes, then importance, elimination and permutation."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import fields
from statistics import median

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.columns import q
from tabloom.operators.encode import assemble, fit_scaler
from tabloom.plans.blocks import BlockBoost, BlockForest, BlockModel, BlockTable, block_table
from tabloom.plans.models import LinearSvr, keep
from tabloom.session import small_table

VOTERS = ["Lasso", "Ridge", "GradientBoost", "RandomForest", "LinearSVR"]
#: MLlib fits the trees of at most this many rows; those of more grow over row blocks (``blocks``).
MLLIB_ROWS = 200_000


def _at_least(values: Sequence[float], factor: float) -> list[int]:
    limit = factor * median(values)
    return [int(v >= limit) for v in values]


def _known(kind, params: Mapping) -> bool:
    return set(params) <= {f.name for f in fields(kind)}


def vote_table(df: DataFrame, features: Sequence[str], label: str, bases: Mapping[str, str] | None = None,
               lasso: float = 1.0, ridge: float = 5.0, boost: Mapping | None = None, forest: Mapping | None = None,
               svr_steps: int = 40, seed: int = 42, mllib_rows: int = MLLIB_ROWS) -> DataFrame:
    """feature, index, base and the votes of five models with their sum.

    Trees are MLlib's up to ``mllib_rows`` rows, beyond that trees of the same kind over row blocks.
    """
    bases = bases or {}
    data = keep(assemble(df, features).select("features", q(label).cast("double").alias("label")))
    n, sigma = data.agg(F.count("*"), F.stddev_pop("label")).first()
    lasso_fit = LinearRegression(regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=500).fit(data)
    # MLlib divides the squared penalty by the label deviation and averages the loss.
    ridge_fit = LinearRegression(solver="normal", regParam=ridge * (sigma or 1.0) / n, elasticNetParam=0.0,
                                 standardization=False).fit(data)
    boost = {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": seed, **(boost or {})}
    forest = {"numTrees": 400, "maxDepth": 10, "seed": seed, **(forest or {})}
    if n > mllib_rows and _known(BlockBoost, boost) and _known(BlockForest, forest):
        table = block_table(data)
        boost_fit, forest_fit = BlockBoost(**boost).fit(table), BlockForest(**forest).fit(table)
        table.unpersist()
    else:
        boost_fit, forest_fit = GBTRegressor(**boost).fit(data), RandomForestRegressor(**forest).fit(data)
    scaler = fit_scaler(data)
    svr = LinearSvr(c=1.0, features="scaled", steps=svr_steps).fit(scaler.transform(data))
    data.unpersist()
    votes = {
        "Lasso": [int(abs(c) > 0) for c in lasso_fit.coefficients.toArray()],
        "Ridge": _at_least(np.abs(ridge_fit.coefficients.toArray()).tolist(), 1.0),
        "GradientBoost": _at_least(boost_fit.featureImportances.toArray().tolist(), 1.25),
        "RandomForest": _at_least(forest_fit.featureImportances.toArray().tolist(), 1.5),
        "LinearSVR": _at_least(np.abs(svr.coefficients).tolist(), 1.0),
    }
    rows = [(f, i, bases.get(f), *[votes[v][i] for v in VOTERS]) for i, f in enumerate(features)]
    table = small_table(df.sparkSession, rows, "feature string, index int, base string, "
                        + ", ".join(f"{v} int" for v in VOTERS))
    total = sum((F.col(v) for v in VOTERS[1:]), F.col(VOTERS[0]))
    return table.withColumn("Sum", total).orderBy(F.desc("Sum"), "feature")


def with_whole_groups(chosen: DataFrame, table: DataFrame) -> DataFrame:
    """The chosen features and every other dummy of a base that has a chosen one."""
    bases = chosen.filter(F.col("base").isNotNull()).select("base").distinct()
    group = table.join(F.broadcast(bases), "base", "left_semi").select(*table.columns)
    return chosen.select(*table.columns).unionByName(group).dropDuplicates(["feature"])


def stage1(votes: DataFrame, threshold: int = 3) -> DataFrame:
    return with_whole_groups(votes.filter(F.col("Sum") >= threshold), votes).orderBy("index")


def stage2_candidates(votes: DataFrame, selected: DataFrame, domain_bases: Sequence[str]) -> DataFrame:
    """Stage-1 features and all dummies of the bases that always take part."""
    domain = votes.filter(F.col("base").isin(list(domain_bases))) if domain_bases else votes.limit(0)
    return selected.unionByName(domain).dropDuplicates(["feature"]).orderBy("index")


def eliminate(data: DataFrame | BlockTable, count: int, keep_n: int, make) -> tuple[list[int], list[int]]:
    """Recursive elimination on vector positions: support and rank (1 = kept)."""
    left, rank = list(range(count)), [1] * count
    while len(left) > keep_n:
        part = (data.sliced(left) if isinstance(data, BlockTable)
                else VectorSlicer(inputCol="features", outputCol="part", indices=left).transform(data))
        scores = make("part").fit(part).featureImportances.toArray()
        worst = int(np.argmin(scores))
        rank[left[worst]] = len(left) - keep_n + 1
        left.pop(worst)
    support = [int(i in left) for i in range(count)]
    return support, rank


def _shifted(df: DataFrame, keys: Sequence[str], x: Column, repeats: int, seed: int, rows_per_block: int) -> DataFrame:
    """For every repeat: all rows with ``x`` and, as ``other``, that of the row they are shifted to."""
    rows = df.select(*[q(k) for k in keys], x.alias("x"), "label")
    blocks = max(1, df.count() // rows_per_block)
    runs = rows.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    ids = [q(k) for k in keys]
    runs = runs.withColumns({"block": F.pmod(F.xxhash64(*ids, "repeat", F.lit(seed)), F.lit(blocks)),
                             "order": F.xxhash64(*ids, "repeat", F.lit(seed + 1))})
    w = Window.partitionBy("repeat", "block").orderBy("order", *ids)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead("x").over(w), F.first("x").over(whole))
    return runs.withColumn("other", other)


def permuted(df: DataFrame, keys: Sequence[str], positions: Sequence[int], repeats: int, seed: int,
             rows_per_block: int = 10_000) -> DataFrame:
    """For every (position, repeat): all rows with that vector position permuted.

    Rows are dealt into blocks by hash and shifted by one place in a second hash order
    inside their block. That is a permutation with no fixed row, and no task orders more
    than a block.
    """
    runs = _shifted(df, keys, vector_to_array("features"), repeats, seed, rows_per_block)
    spread = runs.withColumn("position", F.explode(F.array(*[F.lit(i) for i in positions])))
    mixed = F.transform("x", lambda v, i: F.when(i == F.col("position"), F.element_at("other", i + 1)).otherwise(v))
    return spread.select("position", "repeat", array_to_vector(mixed).alias("features"), "label")


def _block_runs(model: BlockModel, df: DataFrame, keys: Sequence[str], count: int, repeats: int, seed: int,
                rows_per_block: int = 10_000) -> DataFrame:
    """Accuracy per (position, repeat). Only trees that split on a position are walked again for it."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("binary")
    def bins(x: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in held.value.binned(x)] if len(x) else [], dtype=object)

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = held.value
        users = [[i for i, t in enumerate(m.trees) if (t.column[t.gain > 0] == p).any()] for p in range(count)]
        for b in batches:
            if not len(b):
                continue
            x, other = (np.frombuffer(b"".join(b[c]), dtype=np.uint8).reshape(len(b), -1) for c in ("x", "other"))
            repeat, label, out = b["repeat"].to_numpy(), b["label"].to_numpy(dtype=np.float64), []
            values, known = np.stack(list(m.values(x, range(len(m.trees))))), ~np.isnan(label)
            for p in range(count):
                mixed, changed = np.array(x, order="F"), values
                if users[p]:
                    mixed[:, p] = other[:, p]
                    changed = values.copy()
                    changed[users[p]] = list(m.values(mixed, users[p]))
                right = (m.told(changed.sum(axis=0)) == label) & known
                out += [(p, int(r), int(known[repeat == r].sum()), int(right[repeat == r].sum())) for r in np.unique(repeat)]
            yield pd.DataFrame(out, columns=["position", "repeat", "n", "right"])

    runs = _shifted(df, keys, bins(vector_to_array("features")), repeats, seed, rows_per_block)
    counts = runs.select("repeat", "x", "other", "label").mapInPandas(told, "position int, repeat int, n long, right long")
    return counts.groupBy("position", "repeat").agg((F.sum("right") / F.sum("n")).alias("accuracy"))


def permutation_importance(model, df: DataFrame, keys: Sequence[str], count: int, repeats: int = 5,
                           seed: int = 42) -> dict[int, tuple[float, float]]:
    """Mean and deviation of the accuracy lost, per vector position; all runs are scored in one job.

    A ``BlockModel`` sees bin numbers only, so those are shifted, and a task scores a row's positions together.
    """
    base = model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    if isinstance(model, BlockModel):
        runs = _block_runs(model, df, keys, count, repeats, seed)
    else:
        scored = model.transform(permuted(df, keys, list(range(count)), repeats, seed))
        runs = (scored.groupBy("position", "repeat")
                .agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")))
    table = runs.groupBy("position").agg(F.avg(F.lit(base) - F.col("accuracy")).alias("mean"),
                                         F.stddev_pop(F.lit(base) - F.col("accuracy")).alias("std")).collect()
    return {r["position"]: (r["mean"], r["std"]) for r in table}


def stage2(df: DataFrame, candidates: DataFrame, label: str, keys: Sequence[str], keep_n: int = 20,
           repeats: int = 5, seed: int = 42, boost: Mapping | None = None, mllib_rows: int = MLLIB_ROWS) -> DataFrame:
    """Importance, elimination rank and permutation loss of every candidate, and whether it stays.

    Trees are MLlib's up to ``mllib_rows`` rows, beyond that trees of the same kind over row blocks.
    """
    rows = candidates.orderBy("index").collect()
    features = [r["feature"] for r in rows]
    params = {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8", "seed": seed, **(boost or {})}
    data = keep(assemble(df, features).select(*[q(k) for k in keys], "features", q(label).cast("double").alias("label")))

    table = block_table(data) if data.count() > mllib_rows and _known(BlockBoost, params) else None

    def make(column: str):
        return GBTClassifier(featuresCol=column, labelCol="label", **params) if table is None else BlockBoost(**params, logistic=True)

    model = make("features").fit(data if table is None else table)
    gain = model.featureImportances.toArray().tolist()
    support, rank = eliminate(data if table is None else table, len(features), min(keep_n, len(features)), make)
    if table is not None:
        table.unpersist()
    loss = permutation_importance(model, data, keys, len(features), repeats, seed)
    data.unpersist()
    gain_mid, loss_mid = median(gain), median(loss[i][0] for i in range(len(features)))
    table = [(r["feature"], r["index"], r["base"], gain[i], support[i], rank[i], *loss[i],
              bool(support[i] or gain[i] >= gain_mid or loss[i][0] >= loss_mid)) for i, r in enumerate(rows)]
    return small_table(df.sparkSession, table,
                       "feature string, index int, base string, XGB_importance double, RFE_selected int, "
                       "RFE_rank int, PermImp_mean double, PermImp_std double, selected boolean")


def stage2_selected(metrics: DataFrame) -> DataFrame:
    return with_whole_groups(metrics.filter("selected"), metrics).orderBy("index")


def apply_selection(preprocessor, df: DataFrame, names: Sequence[str], keep_columns: Sequence[str] = ()) -> DataFrame:
    """Re-apply the train-fitted encoding and keep the selected features, by name."""
    known = set(preprocessor.names())
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"selected features not produced by the encoder: {unknown}")
    wide = preprocessor.transform(df, keep_columns)
    return wide.select(*[q(c) for c in [*keep_columns, *names]])
