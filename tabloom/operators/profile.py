"""Numeric and categorical profiles, column audits and the data behind the standard charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.numbers import number
from tabloom.operators.columns import q
from tabloom.operators.joins import with_share
from tabloom.operators.ranks import exact_quantiles
from tabloom.session import small_table

QUANTILES = {"p01": 0.01, "p05": 0.05, "q1": 0.25, "median": 0.50, "q3": 0.75, "p95": 0.95, "p99": 0.99}


def _rounded(c, digits: int | None):
    return c if digits is None else F.round(c, digits)


def numeric_profile(df: DataFrame, columns: Sequence[str], digits: int | None = 3,
                    se_digits: int | None = 6) -> DataFrame:
    """One row per numeric column: counts, moments, quantiles, IQR fences, outliers.

    The quantiles come from :func:`exact_quantiles`; everything else is one aggregate
    over the columns side by side, so no row is multiplied and the shuffle is one row
    per task.
    """
    columns = list(columns)
    names = list(QUANTILES)
    cuts = exact_quantiles(df, columns, list(QUANTILES.values()))
    aggs, parts = [F.count("*").alias("rows")], []
    for i, c in enumerate(columns):
        v = number(df, c)
        q1, q3 = cuts[c][2], cuts[c][4]
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"avg{i}"), F.stddev_samp(v).alias(f"sd{i}"),
                 F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
        if q1 is None:
            low = high = iqr = None
            outliers = F.lit(0).cast("bigint")
        else:
            iqr = q3 - q1
            low, high = q1 - 1.5 * iqr, q3 + 1.5 * iqr
            outliers = F.count_if((v < low) | (v > high))
            inside = v.between(low, high)
            aggs += [F.min(F.when(inside, v)).alias(f"wlo{i}"), F.max(F.when(inside, v)).alias(f"whi{i}")]
        aggs.append(outliers.alias(f"out{i}"))
        n, rows = F.col(f"n{i}"), F.col("rows")
        none = F.lit(None).cast("double")
        parts.append(F.struct(
            F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            rows.alias("count"), n.alias("non_null"), (rows - n).alias("missing"),
            _rounded(F.when(rows > 0, (rows - n) / rows * 100).otherwise(0.0), digits).alias("missing_pct"),
            _rounded(F.col(f"avg{i}"), digits).alias("mean"), _rounded(F.col(f"sd{i}"), digits).alias("std"),
            _rounded(F.col(f"sd{i}") / F.sqrt(n), se_digits).alias("se_mean"),
            _rounded(F.col(f"min{i}"), digits).alias("min"),
            *[_rounded(F.lit(x).cast("double"), digits).alias(p) for p, x in zip(names, cuts[c])],
            _rounded(F.col(f"max{i}"), digits).alias("max"),
            _rounded(F.lit(iqr).cast("double"), digits).alias("iqr"),
            _rounded(F.lit(low).cast("double"), digits).alias("lower_fence"),
            _rounded(F.lit(high).cast("double"), digits).alias("upper_fence"),
            F.col(f"out{i}").alias("n_outliers_iqr"),
            _rounded(F.when(n > 0, F.col(f"out{i}") / n * 100), digits).alias("pct_outliers_iqr"),
            (none if q1 is None else F.col(f"wlo{i}")).alias("whisker_low"),
            (none if q1 is None else F.col(f"whi{i}")).alias("whisker_high")))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*parts)).alias("e")).select("e.*")


def describe(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    return numeric_profile(df, columns, digits, digits).select(
        "column", F.col("non_null").alias("count"), "mean", "std", "min", "q1", "median", "q3", "max")


def box_statistics(df: DataFrame, columns: Sequence[str], digits: int | None = 3) -> DataFrame:
    """Quartiles, whisker ends and the number of points beyond them."""
    return numeric_profile(df, columns, digits).select(
        "column", "q1", "median", "q3", "whisker_low", "whisker_high",
        F.col("n_outliers_iqr").alias("fliers"))


def _levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("variable"), q(c).cast("string").alias("level"))
                        for c in columns])
    return df.select(F.explode(entries).alias("e")).select("e.*")


def categorical_distribution(df: DataFrame, columns: Sequence[str], digits: int | None = 3) -> DataFrame:
    """Level counts and percents of every column; null is the level ``NaN``."""
    counts = (_levels(df, columns).groupBy("variable", F.coalesce("level", F.lit("NaN")).alias("level"))
              .agg(F.count("*").alias("count")))
    return with_share(counts, within=["variable"], digits=digits)


def categorical_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(F.count("*").alias("rows"), *[F.count(q(c)).alias(f"n{i}") for i, c in enumerate(columns)])
    parts = [F.struct(F.lit(c).alias("variable"), (F.col("rows") - F.col(f"n{i}")).alias("missing"),
                      F.round((F.col("rows") - F.col(f"n{i}")) / F.col("rows") * 100, 3).alias("missing_pct"))
             for i, c in enumerate(columns)]
    return (wide.select(F.explode(F.array(*parts)).alias("e")).select("e.*")
            .orderBy(F.desc("missing"), "variable"))


def top_levels(df: DataFrame, columns: Sequence[str], k: int = 15, digits: int | None = 3) -> DataFrame:
    """The ``k - 1`` most frequent levels and OTHER, for columns with more than ``k`` levels.

    A column may have a level per row, so its levels are never lined up in one window:
    the leading ones come from a limited window (Spark keeps ``k`` per task before the
    shuffle) and OTHER is the total less their sum.
    """
    dist = (_levels(df, columns).groupBy("variable", F.coalesce("level", F.lit("NaN")).alias("level"))
            .agg(F.count("*").alias("n")))
    totals = dist.groupBy("variable").agg(F.sum("n").alias("total"), F.count("*").alias("levels"))
    order = Window.partitionBy("variable").orderBy(F.desc("n"), "level")
    lead = dist.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)
    joined = lead.join(totals, "variable").filter((F.col("levels") <= k) | (F.col("rn") < k))
    shown = joined.select("variable", "level", "n", "total")
    rest = (joined.filter(F.col("levels") > k).groupBy("variable", "total")
            .agg(F.sum("n").alias("kept"))
            .select("variable", F.lit("OTHER").alias("level"), (F.col("total") - F.col("kept")).alias("n"), "total"))
    return shown.unionByName(rest).select(
        "variable", "level", "n", _rounded(F.col("n") / F.col("total") * 100, digits).alias("percent"))


def median_category(df: DataFrame, column: str) -> str | None:
    """First level, by falling share then name, at which the running share reaches one half.

    The running share is taken over the distinct counts (at most sqrt(2 x rows) of them),
    not over the levels, of which there may be one per row.
    """
    counts = (df.filter(q(column).isNotNull()).groupBy(q(column).alias("level"))
              .agg(F.count("*").alias("n")))
    steps = counts.groupBy("n").agg(F.count("*").alias("levels"), F.sum("n").alias("rows"))
    total = steps.agg(F.sum("rows")).first()[0]
    if not total:
        return None
    w = Window.orderBy(F.desc("n"))
    step = (steps.withColumn("upto", F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .filter(F.col("upto") / F.lit(total) >= 0.5).orderBy(F.desc("n")).first())
    tied = counts.filter(F.col("n") == step["n"]).select("level")
    if step["levels"] == 1:
        return tied.first()["level"]
    needed = math.ceil(total / 2 - (step["upto"] - step["rows"]))
    nth = max(1, math.ceil(needed / step["n"]))
    # Distributed sort with positions; only the wanted level comes back.
    return tied.orderBy("level").rdd.zipWithIndex().filter(lambda p: p[1] == nth - 1).first()[0]["level"]


def fill_median_category(df: DataFrame, column: str) -> DataFrame:
    level = median_category(df, column)
    return df if level is None else df.withColumn(column, F.coalesce(q(column), F.lit(level)))


def column_audit(df: DataFrame, columns: Sequence[str], key: Sequence[str], missing_limit: float = 0.40,
                 level_limit: int = 40) -> DataFrame:
    """Missing share, distinct count, zero variance, cardinality, 0/1 content and duplicates per column."""
    columns = list(columns)
    kinds = {f.name: f.dataType for f in df.schema}
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        aggs.append(F.count(q(c)).alias(f"n{i}"))
        if isinstance(kinds[c], T.NumericType):
            aggs.append(F.bool_and(q(c).isin(0, 1)).alias(f"b{i}"))
        h = F.xxhash64(*[q(k) for k in key], q(c))
        aggs += [F.bit_xor(h).alias(f"x{i}"), F.sum(F.pmod(h, F.lit(1 << 20))).alias(f"s{i}")]
    facts = df.agg(*aggs).first()
    distinct = {r["variable"]: r["n"] for r in
                _levels(df, columns).filter(F.col("level").isNotNull()).distinct()
                .groupBy("variable").agg(F.count("*").alias("n")).collect()}
    same = duplicate_columns(df, columns, {c: (facts[f"x{i}"], facts[f"s{i}"]) for i, c in enumerate(columns)})
    rows = []
    for i, c in enumerate(columns):
        total, n = facts["rows"], facts[f"n{i}"]
        levels = distinct.get(c, 0)
        ratio = (total - n) / total if total else 0.0
        binary = bool(isinstance(kinds[c], T.NumericType) and not isinstance(kinds[c], T.LongType)
                      and (n == 0 or facts[f"b{i}"]))
        rows.append((c, kinds[c].simpleString(), n, ratio, ratio > missing_limit, levels, levels <= 1,
                     isinstance(kinds[c], T.StringType) and levels > level_limit, binary, same.get(c)))
    return small_table(df.sparkSession, rows,
                       "column string, dtype string, non_null bigint, missing_ratio double, high_missing boolean, "
                       "n_distinct bigint, zero_variance boolean, high_cardinality boolean, "
                       "binary_like boolean, duplicate_of string")


def duplicate_columns(df: DataFrame, columns: Sequence[str], prints: dict) -> dict[str, str]:
    """First equal earlier column, by matching fingerprints that one more pass verifies."""
    kinds = {f.name: f.dataType for f in df.schema}
    pairs = [(a, b) for j, b in enumerate(columns) for a in columns[:j]
             if kinds[a] == kinds[b] and prints[a] == prints[b]]
    if not pairs:
        return {}
    checks = df.agg(*[F.bool_and(q(a).eqNullSafe(q(b))).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]).first()
    found: dict[str, str] = {}
    for i, (a, b) in enumerate(pairs):
        if checks[f"p{i}"]:
            found.setdefault(b, a)
    return found


def cast_binary_like(df: DataFrame, audit: DataFrame) -> DataFrame:
    names = {r["column"] for r in audit.filter("binary_like").collect()}
    return df.select(*[q(c).cast("bigint").alias(c) if c in names else q(c) for c in df.columns])


def widest_columns(df: DataFrame, columns: Sequence[str], k: int = 12) -> DataFrame:
    """Columns with a positive standard deviation, the ``k`` largest."""
    wide = df.agg(*[F.stddev_samp(number(df, c)).alias(f"s{i}") for i, c in enumerate(columns)])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("std")) for i, c in enumerate(columns)]
    return (wide.select(F.explode(F.array(*parts)).alias("e")).select("e.*")
            .filter(F.col("std") > 0).orderBy(F.desc("std"), "column").limit(k))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed on both sides."""
    columns = list(columns)
    ends = df.agg(*[a for i, c in enumerate(columns) for a in
                    (F.min(number(df, c)).alias(f"lo{i}"), F.max(number(df, c)).alias(f"hi{i}"))]).first()
    entries = []
    for i, c in enumerate(columns):
        low, high = ends[f"lo{i}"], ends[f"hi{i}"]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        v = number(df, c)
        b = F.least(F.floor((v - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
        entries.append(F.struct(F.lit(c).alias("column"), b.alias("bin"),
                                F.lit(low).alias("low"), F.lit((high - low) / bins).alias("width")))
    return (df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(F.col("bin").isNotNull())
            .groupBy("column", "bin", "low", "width").agg(F.count("*").alias("count"))
            .select("column", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("left"), "count"))


def hexbin(df: DataFrame, x: str, y: str, grid: int = 60, min_count: int = 1) -> DataFrame:
    """Hexagonal cell counts: each point goes to the nearer centre of two shifted lattices."""
    ends = df.filter(q(x).isNotNull() & q(y).isNotNull()).agg(
        F.min(q(x)), F.max(q(x)), F.min(q(y)), F.max(q(y))).first()
    x0, x1, y0, y1 = (float(v) for v in ends)
    rows = int(grid / math.sqrt(3))
    sx, sy = (x1 - x0) / grid or 1.0, (y1 - y0) / rows or 1.0
    u, v = (q(x) - x0) / sx, (q(y) - y0) / sy
    on = (F.rint(u), F.rint(v))
    off = (F.floor(u).cast("double"), F.floor(v).cast("double"))
    d_on = F.pow(u - on[0], 2) + 3 * F.pow(v - on[1], 2)
    d_off = F.pow(u - off[0] - 0.5, 2) + 3 * F.pow(v - off[1] - 0.5, 2)
    cell = F.when(d_on < d_off, F.struct((on[0] * 2).cast("int").alias("hx"), (on[1] * 2).cast("int").alias("hy")))
    cell = cell.otherwise(F.struct((off[0] * 2 + 1).cast("int").alias("hx"), (off[1] * 2 + 1).cast("int").alias("hy")))
    return (df.filter(q(x).isNotNull() & q(y).isNotNull()).select(cell.alias("c")).select("c.*")
            .groupBy("hx", "hy").agg(F.count("*").alias("count")).filter(F.col("count") >= min_count))
