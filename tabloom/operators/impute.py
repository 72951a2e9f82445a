"""Imputers: group draws, k nearest neighbours, chained regressions, medians.

All are fitted on training rows and applied unchanged to any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.numbers import key_hash, number
from tabloom.operators.columns import q
from tabloom.operators.neighbors import nearest
from tabloom.operators.ranks import ROWS_PER_BUCKET, exact_quantiles, group_quantiles, value_ranks
from tabloom.session import BROADCAST_ROWS, cut_lineage, fits, small_table

POOL_WIDTH = 1_000_000
DRAWS_PER_TASK = 1_000_000
# Patterns of gaps whose moments go to the driver, and columns up to which every pattern gets a row of coefficients.
MOMENT_PATTERNS, PATTERN_COLUMNS = 1_024, 12


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(q(c), F.lit(v)) for c, v in values.items() if c in df.columns})


def group_medians(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Exact median per (group, feature)."""
    return group_quantiles(df, features, by, [0.5]).select(*by, F.col("column").alias("feature"),
                                                           F.col("q0").alias("median"))


def _not_null(names: Sequence[str]) -> Column:
    c = F.lit(True)
    for n in names:
        c = c & q(n).isNotNull()
    return c


@dataclass
class GroupDrawImputer:
    """Fills a null with a value drawn from the training values of the row's group.

    A group without values falls back to all training values, and a feature without any
    to its default. The pool is a table of distinct values with their positions in the
    sorted pool, so a frequent value is one row. A row's draw is a position computed from
    its key; positions are looked up by a sorted walk over pool slices, not by a join
    that would pair draws with pool rows.
    """

    features: list[str]
    by: list[str]
    keys: list[str]
    seed: int = 42
    pool_width: int = POOL_WIDTH
    draws_per_task: int = DRAWS_PER_TASK
    rows_per_bucket: int = ROWS_PER_BUCKET
    medians: dict = field(default_factory=dict)
    pools: DataFrame | None = None

    def fit(self, train: DataFrame) -> GroupDrawImputer:
        present = [f for f in self.features if f in train.columns]
        self.features = present
        self.medians = {f: v[0] for f, v in exact_quantiles(train, present, [0.5]).items()}
        grouped = value_ranks(train.filter(_not_null(self.by)), present, self.by, rows_per_bucket=self.rows_per_bucket)
        everything = value_ranks(train, present, rows_per_bucket=self.rows_per_bucket)
        parts = [grouped.withColumn("overall", F.lit(False)), everything.withColumn("overall", F.lit(True))]
        pools = parts[0].unionByName(parts[1], allowMissingColumns=True)
        self.pools = cut_lineage(pools.select("overall", *self.by, F.col("column").alias("feature"),
                                              "value", "n", "before"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Only rows with a gap take part in the shuffles; complete rows pass through."""
        features = [f for f in self.features if f in df.columns]
        if not features or self.pools is None:
            return df
        values = {f: number(df, f) for f in features}
        complete = F.lit(True)
        for v in values.values():
            complete = complete & v.isNotNull()
        gaps = df.filter(~complete)
        filled = self._draws(gaps, features)
        wide = filled.groupBy(*[f"_k{i}" for i in range(len(self.keys))]).agg(
            *[F.max(F.when(F.col("feature") == f, F.col("value"))).alias(f"_f{i}") for i, f in enumerate(features)])
        match = F.lit(True)
        for i, k in enumerate(self.keys):
            match = match & (q(k) == F.col(f"_k{i}"))
        joined = gaps.join(wide, match, "left")
        kinds = {f: df.schema[f].dataType for f in features}
        fixed = joined.withColumns({
            f: F.coalesce(values[f], F.col(f"_f{i}"), F.lit(self.medians.get(f))).cast(kinds[f])
            for i, f in enumerate(features)}).select(*[q(c) for c in df.columns])
        return df.filter(complete).unionByName(fixed)

    def _draws(self, gaps: DataFrame, features: list[str]) -> DataFrame:
        by, width = self.by, self.pool_width
        sizes = self.pools.groupBy("overall", *by, "feature").agg(F.sum("n").alias("size"))
        overall = {r["feature"]: r["size"] for r in sizes.filter("overall").collect()}
        wanted = F.array(*[F.when(number(gaps, f).isNull(), F.struct(
            F.lit(f).alias("feature"), key_hash(gaps, self.keys, self.seed, f).alias("h"),
            F.lit(overall.get(f)).cast("bigint").alias("all_size"))) for i, f in enumerate(features)])
        asks = (gaps.select(*[q(k).alias(f"_k{i}") for i, k in enumerate(self.keys)],
                            *[q(b).alias(f"_b{i}") for i, b in enumerate(by)], F.explode(wanted).alias("e"))
                .filter(F.col("e").isNotNull()).select("*", "e.*").drop("e"))
        groups = sizes.filter("not overall").select(
            *[F.col(b).alias(f"_g{i}") for i, b in enumerate(by)], F.col("feature").alias("_gf"), "size")
        if fits(groups):
            groups = F.broadcast(groups)
        match = F.col("feature") == F.col("_gf")
        for i in range(len(by)):
            match = match & (F.col(f"_b{i}") == F.col(f"_g{i}"))
        asks = asks.join(groups, match, "left")
        asks = asks.select(
            *[f"_k{i}" for i in range(len(self.keys))], "feature", "h", F.col("size").isNull().alias("overall"),
            *[F.col(f"_g{i}").alias(b) for i, b in enumerate(by)],
            F.coalesce("size", "all_size").alias("size")).filter(F.col("size") > 0)
        # Pools beyond the 32-bit range of the arithmetic hash draw from a 64-bit one.
        wide = F.xxhash64(*[f"_k{i}" for i in range(len(self.keys))], "feature", F.lit(self.seed))
        asks = asks.withColumn("pos", F.when(F.col("size") <= 1 << 32, F.pmod(F.col("h"), F.col("size")))
                               .otherwise(F.pmod(wide, F.col("size"))))
        # Narrow rows, one per gap; stored, because the load check and the walk both read them.
        asks = cut_lineage(asks.withColumn("slice", F.floor(F.col("pos") / width).cast("bigint")))
        pool_id = ["overall", *by, "feature"]
        # Salts: a slice with more draws than one task should take is copied that many times.
        load = asks.groupBy(*pool_id, "slice").agg(F.count("*").alias("asked"))
        heavy = load.filter(F.col("asked") > self.draws_per_task)
        salts = heavy.select(*pool_id, "slice", F.ceil(F.col("asked") / self.draws_per_task).cast("int").alias("salts"))
        salts = F.broadcast(salts) if fits(salts) else salts
        asks = _null_safe_left(asks, salts, [*pool_id, "slice"], "salts")
        asks = asks.withColumn("salt", F.pmod(F.xxhash64(*[f"_k{i}" for i in range(len(self.keys))]),
                                              F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        first, last = F.floor(F.col("before") / width), F.floor((F.col("before") + F.col("n") - 1) / width)
        pool = (self.pools.withColumn("slice", F.explode(F.sequence(first, last)))
                .withColumn("pos", F.greatest(F.col("before"), F.col("slice") * width)))
        pool = _null_safe_left(pool, salts, [*pool_id, "slice"], "salts")
        pool = (pool.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
                .select(*pool_id, "slice", "salt", "pos", F.lit(0).alias("ask"), "value"))
        keys = [f"_k{i}" for i in range(len(self.keys))]
        both = pool.unionByName(asks.select(*pool_id, "slice", "salt", "pos", F.lit(1).alias("ask"), *keys),
                                allowMissingColumns=True)
        walk = (Window.partitionBy(*pool_id, "slice", "salt").orderBy("pos", "ask")
                .rowsBetween(Window.unboundedPreceding, 0))
        return (both.withColumn("value", F.last("value", ignorenulls=True).over(walk))
                .filter(F.col("ask") == 1).select(*keys, "feature", "value"))


def _null_safe_left(left: DataFrame, right: DataFrame, on: list[str], value: str) -> DataFrame:
    other = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], value)
    match = F.lit(True)
    for c in on:
        match = match & left[c].eqNullSafe(F.col(f"_r_{c}"))
    return left.join(other, match, "left").drop(*[f"_r_{c}" for c in on])


@dataclass
class MedianImputer:
    """Exact training medians for every numeric column, with or without gaps in training."""

    columns: list[str]
    medians: dict = field(default_factory=dict)

    def fit(self, train: DataFrame) -> MedianImputer:
        self.medians = {c: v[0] for c, v in exact_quantiles(train, self.columns, [0.5]).items()}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(number(df, c), F.lit(m)) for c, m in self.medians.items()
                               if c in df.columns and m is not None})


@dataclass
class KnnImputer:
    """k nearest neighbours with inverse-distance weights over the columns both rows have.

    Rows and donors are reduced to distinct value tuples. For each pattern of missing
    columns and each target column the search is a nearest-neighbour query in the space
    of the common columns; all of them run as one join with the pattern as group.
    """

    columns: list[str]
    k: int = 5
    means: dict = field(default_factory=dict)
    donors: DataFrame | None = None
    max_broadcast: int = BROADCAST_ROWS

    def fit(self, train: DataFrame) -> KnnImputer:
        names = self._names()
        narrow = train.select(*[number(train, c).alias(n) for c, n in zip(self.columns, names)])
        self.donors = cut_lineage(narrow.groupBy(*names).agg(F.count("*").alias("n")))
        row = self.donors.agg(*[(F.sum(F.col(n) * F.col("n")) / F.sum(F.when(F.col(n).isNotNull(), F.col("n")))).alias(n)
                                for n in names]).first()
        self.means = {c: row[n] for c, n in zip(self.columns, names)}
        return self

    def _names(self) -> list[str]:
        return [f"v{i}" for i in range(len(self.columns))]

    def transform(self, df: DataFrame, source: DataFrame | None = None) -> DataFrame:
        """``source``: an earlier form of ``df`` with the same values in these columns, cheaper to scan."""
        names, p = self._names(), len(self.columns)
        values = {n: number(df, c) for c, n in zip(self.columns, names)}
        complete = F.lit(True)
        for v in values.values():
            complete = complete & v.isNotNull()
        gaps = df.filter(~complete)
        scan = df if source is None else source
        tuples = scan.select(*[number(scan, c).alias(n) for c, n in zip(self.columns, names)])
        asked = cut_lineage(tuples.filter(F.greatest(*[F.col(n).isNull() for n in names])
                                          if p > 1 else F.col(names[0]).isNull()).distinct()
                            .withColumn("gap", _pattern(names)))
        patterns = sorted(r["gap"] for r in asked.select("gap").distinct().collect())
        answers = self._search(asked, patterns, names) if patterns else None
        if answers is None:
            return df
        match = F.lit(True)
        for n in names:
            match = match & values[n].eqNullSafe(F.col(f"_a_{n}"))
        # One row per distinct gap tuple; stored, so that the search runs once.
        answers = cut_lineage(answers.select(*[F.col(n).alias(f"_a_{n}") for n in names], *[f"f{i}" for i in range(p)]))
        if fits(answers, self.max_broadcast):
            answers = F.broadcast(answers)
        joined = gaps.join(answers, match, "left")
        fixed = joined.withColumns({c: F.coalesce(values[n], F.col(f"f{i}"), F.lit(self.means[c]))
                                    for i, (c, n) in enumerate(zip(self.columns, names))})
        whole = df.filter(complete).withColumns({c: values[n] for c, n in zip(self.columns, names)})
        return whole.unionByName(fixed.select(*[q(c) for c in df.columns]))

    def _search(self, asked: DataFrame, patterns: list[int], names: list[str]) -> DataFrame:
        p = len(names)
        full = (1 << p) - 1
        runs: dict[tuple[int, int, int], int] = {}
        for gap in patterns:
            for c in range(p):
                if gap >> c & 1:
                    have = full & ~gap
                    sub = have
                    while sub:
                        runs[gap, c, sub] = len(runs)
                        sub = (sub - 1) & have

        def projected(sub: int) -> list[Column]:
            return [(F.col(n) if sub >> i & 1 else F.lit(0.0)).alias(f"x{i}") for i, n in enumerate(names)]

        ask_arms, give_arms = None, None
        for gap in patterns:
            arms = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(c).alias("target"),
                                      F.lit(p / bin(sub).count("1")).alias("scale"), *projected(sub))
                             for (g, c, sub), r in runs.items() if g == gap]) if gap != full else None
            if arms is None:
                continue
            here = F.col("gap") == gap
            ask_arms = F.when(here, arms) if ask_arms is None else ask_arms.when(here, arms)
        donors = self.donors.withColumn("gap", _pattern(names))
        for dp in sorted(r["gap"] for r in donors.select("gap").distinct().collect()):
            arms = [F.struct(F.lit(r).alias("run"), F.col(names[c]).alias("value"), *projected(sub))
                    for (g, c, sub), r in runs.items() if not dp >> c & 1 and (full & ~g & ~dp) == sub]
            if arms:
                here = F.col("gap") == dp
                give_arms = F.when(here, F.array(*arms)) if give_arms is None else give_arms.when(here, F.array(*arms))
        if ask_arms is None or give_arms is None:
            return None
        xs = [f"x{i}" for i in range(p)]
        asks = asked.select(*names, F.explode(ask_arms).alias("e")).select(*names, "e.*")
        gives = (donors.select("n", F.explode(give_arms).alias("e")).select("n", "e.*")
                 .groupBy("run", *xs, "value").agg(F.sum("n").alias("n")))
        found = nearest(asks.select("run", *xs).distinct(), gives, xs, ["value"], k=self.k, group="run", weight="n",
                        split_source=self.donors.select(*[F.col(n).alias(x) for n, x in zip(names, xs)]),
                        max_broadcast=self.max_broadcast)
        hits = asks.join(found.select("run", *xs, "value", "d2", "n"), ["run", *xs])
        hits = hits.withColumn("d2", F.col("d2") * F.col("scale"))
        order = Window.partitionBy(*names, "target").orderBy("d2", "value")
        best = (hits.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= self.k)
                .withColumn("earlier", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
                .filter(F.col("earlier") < self.k)
                .withColumn("n", F.least(F.col("n"), F.lit(self.k) - F.col("earlier"))))
        zero = F.col("d2") == 0
        inverse = F.try_divide(F.col("n"), F.sqrt("d2"))
        exact = F.sum(F.when(zero, F.col("n") * F.col("value"))) / F.sum(F.when(zero, F.col("n")))
        blended = F.try_divide(F.sum(F.when(~zero, inverse * F.col("value"))), F.sum(F.when(~zero, inverse)))
        per_target = best.groupBy(*names, "target").agg(F.coalesce(exact, blended).alias("fill"))
        return per_target.groupBy(*names).agg(
            *[F.max(F.when(F.col("target") == i, F.col("fill"))).alias(f"f{i}") for i in range(p)])


def _pattern(names: Sequence[str]) -> Column:
    """Bit i is set where column i is null."""
    bits = F.lit(0)
    for i, n in enumerate(names):
        bits = bits + F.when(F.col(n).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return bits


@dataclass
class ChainedImputer:
    """Chained Bayesian ridge regressions from a median start.

    Every imputed value is an affine function of the row's observed values, one function
    per pattern of missing columns. So the moments of the observed values per pattern,
    one aggregate over the training rows, are all the fit needs: regressions for every
    column and round are solved from them, and applying the model is one projection.
    Only the stopping rule looks at the rows with gaps again, once per round.

    Rows with more than MOMENT_PATTERNS different patterns are passed over instead, once for each
    column and round; tasks send one matrix of second moments each and nothing is shuffled.
    Beyond PATTERN_COLUMNS columns the model is applied step by step in Arrow batches.
    """

    columns: list[str]
    max_rounds: int = 10
    tolerance: float = 1e-3
    medians: list = field(default_factory=list)
    steps: list = field(default_factory=list)
    rounds: int = 0

    def fit(self, train: DataFrame) -> ChainedImputer:
        p = len(self.columns)
        names = [f"v{i}" for i in range(p)]
        narrow = train.select(*[number(train, c).alias(n) for c, n in zip(self.columns, names)])
        med = exact_quantiles(narrow, names, [0.5])
        self.medians = [med[n][0] for n in names]
        if any(m is None for m in self.medians):
            raise ValueError("a column without training values cannot be imputed")
        centre = np.array(self.medians, dtype=float)
        z = [F.coalesce(F.col(n) - F.lit(float(m)), F.lit(0.0)) for n, m in zip(names, centre)]
        aggs = [F.count("*").alias("n"), *[F.max(F.abs(n)).alias(f"m{i}") for i, n in enumerate(names)]]
        aggs += [F.sum(z[i]).alias(f"s{i}") for i in range(p)]
        aggs += [F.sum(z[i] * z[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]
        if p > 62 or p > PATTERN_COLUMNS and narrow.select(_pattern(names).alias("gap")).distinct().limit(MOMENT_PATTERNS + 1).count() > MOMENT_PATTERNS:
            return self._fit_by_rows(narrow.select(*[(F.col(n) - F.lit(float(m))).alias(n) for n, m in zip(names, centre)]), names, centre)
        coded = narrow.withColumn("gap", _pattern(names))
        moments, size = {}, 0.0
        for row in coded.groupBy("gap").agg(*aggs).collect():
            s = np.zeros((p + 1, p + 1))
            for i in range(p):
                s[i, p] = s[p, i] = row[f"s{i}"]
                for j in range(i, p):
                    s[i, j] = s[j, i] = row[f"s{i}_{j}"]
            s[p, p] = row["n"]
            moments[row["gap"]] = s
            size = max([size, *[row[f"m{i}"] or 0.0 for i in range(p)]])
        gaps_in = [sum(s[p, p] for g, s in moments.items() if g >> j & 1) for j in range(p)]
        order = [j for j in sorted(range(p), key=lambda j: gaps_in[j]) if gaps_in[j] > 0]
        maps = {g: _start(g, p, np.zeros(p)) for g in moments}
        holes = coded.filter(F.col("gap") > 0)
        for _round in range(self.max_rounds if order else 0):
            before = {g: m.copy() for g, m in maps.items()}
            for j in order:
                gram = sum(_lift(maps[g], p) @ s @ _lift(maps[g], p).T for g, s in moments.items() if not g >> j & 1)
                coef, intercept = _bayes_ridge(gram, j, p)
                _advance(maps, j, coef, intercept)
                shift = centre[j] + intercept - float(coef @ centre)
                self.steps.append((j, coef.tolist(), float(shift)))
            self.rounds += 1
            moves = [(g, (maps[g] - before[g])[j].tolist()) for g in maps if g for j in range(p) if g >> j & 1]
            table = small_table(train.sparkSession, moves, "gap bigint, a array<double>")
            moved = holes.join(F.broadcast(table), "gap").agg(F.max(F.abs(_affine("a", z)))).first()[0]
            if moved < self.tolerance * size:
                break
        return self

    def _fit_by_rows(self, centred: DataFrame, names: list[str], centre: np.ndarray) -> ChainedImputer:
        """The same regressions from the rows themselves: the rows with their fills are written once a round."""
        p, spark = len(names), centred.sparkSession
        facts = centred.agg(*[F.count_if(F.col(n).isNull()).alias(f"g{i}") for i, n in enumerate(names)],
                            *[F.max(F.abs(F.col(n) + F.lit(float(m)))).alias(f"m{i}") for i, (n, m) in enumerate(zip(names, centre))]).first()
        order = [j for j in sorted(range(p), key=lambda j: facts[f"g{j}"]) if facts[f"g{j}"]]
        size = max(facts[f"m{i}"] for i in range(p))
        state = cut_lineage(centred.select(F.array(*[F.col(n).isNull() for n in names]).alias("gap"), F.array(*[F.coalesce(n, F.lit(0.0)) for n in names]).alias("z")))
        for _round in range(self.max_rounds):
            done: list[tuple] = []
            for j in order:
                # One row of (p + 1)^2 sums per task.
                parts = state.mapInArrow(_grams(done, j, p), "s array<double>").collect()
                coef, intercept = _bayes_ridge(np.sum([r["s"] for r in parts], axis=0).reshape(p + 1, p + 1), j, p)
                done.append((j, coef, intercept))
                self.steps.append((j, coef.tolist(), float(centre[j] + intercept - float(coef @ centre))))
            self.rounds += 1
            state = cut_lineage(state.mapInArrow(_advanced(done, p), "gap array<boolean>, z array<double>, moved double"))
            if state.agg(F.max("moved")).first()[0] < self.tolerance * size:
                break
            state = state.drop("moved")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        p = len(self.columns)
        values = [number(df, c) for c in self.columns]
        if p > PATTERN_COLUMNS:
            free = "_" * (1 + max(len(c) for c in df.columns)) + "chained"
            filled = df.withColumn(free, _chain_udf(self.medians, self.steps)(F.array(*values)))
            return filled.withColumns({c: F.col(free)[j] for j, c in enumerate(self.columns)}).select(*[q(c) for c in df.columns])
        maps = {g: _start(g, p, np.array(self.medians, dtype=float)) for g in range(1, 1 << p)}
        for j, coef, shift in self.steps:
            _advance(maps, j, np.array(coef), shift)
        gap = F.lit(0)
        for i, v in enumerate(values):
            gap = gap + F.when(v.isNull(), F.lit(1 << i)).otherwise(F.lit(0))
        # One row of coefficients per pattern: 2^p - 1 rows, so a broadcast of known size.
        table = small_table(df.sparkSession, [(g, *[m[j].tolist() if g >> j & 1 else None for j in range(p)])
                                              for g, m in maps.items()],
                            "_gap int, " + ", ".join(f"_a{j} array<double>" for j in range(p)))
        z = [F.coalesce(v, F.lit(0.0)) for v in values]
        joined = df.withColumn("_gap", gap).join(F.broadcast(table), "_gap", "left")
        return joined.withColumns({c: F.coalesce(values[j], _affine(f"_a{j}", z)) for j, c in enumerate(self.columns)}
                                  ).select(*[q(c) for c in df.columns])


def _matrix(column: pa.Array, p: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, p)


def _run(z: np.ndarray, gap: np.ndarray, steps: Sequence[tuple]) -> np.ndarray:
    """The steps (column, coefficients, constant) in turn, each on the rows with a gap in its column."""
    z = z.copy()
    for j, coef, constant in steps:
        at = gap[:, j]
        z[at, j] = z[at] @ np.asarray(coef) + constant
    return z


def _grams(done: list[tuple], j: int, p: int):
    """Second moments of the rows that have column ``j``, after the round's steps so far; one row per task."""
    def run(batches):
        total = np.zeros((p + 1, p + 1))
        for batch in batches:
            gap = _matrix(batch.column("gap"), p).astype(bool)
            z = _run(_matrix(batch.column("z"), p), gap, done)[~gap[:, j]]
            z = np.hstack([z, np.ones((len(z), 1))])
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["s"])
    return run


def _advanced(done: list[tuple], p: int):
    """Rows after a whole round, with the largest change of a fill."""
    def run(batches):
        for batch in batches:
            gap, z = _matrix(batch.column("gap"), p).astype(bool), _matrix(batch.column("z"), p)
            new = _run(z, gap, done)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(new) + 1) * p, pa.int32()), pa.array(new.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("gap"), lists, pa.array(np.abs(new - z).max(axis=1, initial=0.0))], names=["gap", "z", "moved"])
    return run


def _chain_udf(medians: Sequence[float], steps: Sequence[tuple]):
    @F.pandas_udf("array<double>")
    def chained(values: pd.Series) -> pd.Series:
        if values.empty:
            return values
        z = np.array([[np.nan if x is None else x for x in row] for row in values], dtype=float)
        gap = np.isnan(z)
        return pd.Series(list(_run(np.where(gap, np.asarray(medians, dtype=float), z), gap, steps)))
    return chained


def _start(gap: int, p: int, fill: np.ndarray) -> np.ndarray:
    m = np.zeros((p, p + 1))
    for i in range(p):
        if gap >> i & 1:
            m[i, p] = fill[i]
        else:
            m[i, i] = 1.0
    return m


def _lift(m: np.ndarray, p: int) -> np.ndarray:
    return np.vstack([m, np.eye(1, p + 1, p)])


def _advance(maps: dict, j: int, coef: np.ndarray, intercept: float) -> None:
    for g, m in maps.items():
        if g >> j & 1:
            row = coef @ m
            row[-1] += intercept
            m[j] = row


def _affine(coefficients: str, z: Sequence[Column]) -> Column:
    """Dot product with an array column whose last element is the constant."""
    total = F.col(coefficients)[len(z)]
    for i, c in enumerate(z):
        total = total + F.col(coefficients)[i] * c
    return total


def _bayes_ridge(gram: np.ndarray, j: int, p: int) -> tuple[np.ndarray, float]:
    """Evidence-maximising ridge regression of column ``j`` on the others, from second moments."""
    others = [i for i in range(p) if i != j]
    n = gram[p, p]
    mean = gram[:p, p] / n
    centred = gram[:p, :p] - n * np.outer(mean, mean)
    xx, xy, yy = centred[np.ix_(others, others)], centred[others, j], centred[j, j]
    s, v = np.linalg.eigh(xx)
    s = np.maximum(s, 0.0)
    tiny = 1e-6
    alpha, lam = 1.0 / (yy / n + np.finfo(float).eps), 1.0
    rotated = v.T @ xy

    def solve() -> np.ndarray:
        return v @ (rotated / (s + lam / alpha))

    old = None
    for _ in range(300):
        w = solve()
        rest = max(yy - 2 * w @ xy + w @ xx @ w, 0.0)
        used = float(np.sum(alpha * s / (lam + alpha * s)))
        lam = (used + 2 * tiny) / (float(w @ w) + 2 * tiny)
        alpha = (n - used + 2 * tiny) / (rest + 2 * tiny)
        if old is not None and np.abs(old - w).sum() < 1e-3:
            break
        old = w
    w = solve()
    coef = np.zeros(p)
    coef[others] = w
    return coef, float(mean[j] - w @ mean[others])
