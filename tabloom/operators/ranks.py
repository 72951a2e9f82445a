"""Order statistics that never bring a whole column, or a whole group, into one task.

``exact_quantiles`` narrows value ranges with small histograms (a few narrow scans, each
shuffling at most ``bins`` rows per column and task) and sorts only the values around the
wanted ranks. ``value_ranks`` gives every distinct value its rank: values are counted
first, so a value held by a third of all rows is one row, and then sorted in range
buckets whose offsets are added afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.numbers import cut, number
from tabloom.session import small_table

BINS = 2048
SORT_ROWS = 200_000
ROWS_PER_BUCKET = 500_000


def _position(n: int, p: float) -> tuple[int, float]:
    exact = (n - 1) * p
    low = math.floor(exact)
    return low, exact - low


def _stretch(v: Column) -> Column:
    """Order-preserving scale on which every power of two takes the same room."""
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log2(F.abs(v)) + F.lit(1080.0)))


def _bin_of(v: Column, low: Column, high: Column, bins: int, stretch: Column | None = None) -> Column:
    """Bin of ``v`` in [low, high], low < high: the ends fall into different bins.

    The widest ranges are halved first, so that their width stays finite.
    """
    huge = F.greatest(F.abs(low), F.abs(high)) > 1e300
    half = F.when(huge, F.lit(0.5)).otherwise(F.lit(1.0))
    at = (v * half - low * half) / (high * half - low * half)
    if stretch is not None:
        wide = F.try_divide(_stretch(v) - _stretch(low), _stretch(high) - _stretch(low))
        at = F.when(stretch, F.coalesce(wide, at)).otherwise(at)
    return F.greatest(F.lit(0), F.least(F.floor(at * bins), F.lit(bins - 1))).cast("bigint")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    bins: int = BINS, sort_rows: int = SORT_ROWS) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation; null and NaN are skipped.

    Returns columns x probs numbers. Each pass narrows the range around a wanted rank by
    the factor ``bins``; a range with at most ``sort_rows`` rows is sorted. Infinities are
    counted apart. Where a pass gains little (values of very different size), the next one
    divides by powers of two, so any range of doubles ends after a few passes.
    """
    columns = list(columns)
    whole = df.select(*[number(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    finite = [F.when(F.abs(f"v{i}") < math.inf, F.col(f"v{i}")) for i in range(len(columns))]
    narrow = whole.select(*[v.alias(f"v{i}") for i, v in enumerate(finite)])
    aggs = []
    for i, v in enumerate(finite):
        aggs += [F.count(f"v{i}").alias(f"n{i}"), F.count(v).alias(f"f{i}"), F.count_if(F.col(f"v{i}") == -math.inf).alias(f"neg{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    head = whole.agg(*aggs).first()

    found: dict[tuple[int, int], float] = {}
    ranges = []
    for i in range(len(columns)):
        n = head[f"n{i}"]
        if n:
            ranks = set()
            for p in probs:
                low, share = _position(n, p)
                ranks |= {low, low + 1} if share else {low}
            before, inside = head[f"neg{i}"], head[f"f{i}"]
            found |= {(i, k): -math.inf if k < before else math.inf for k in ranks if not before <= k < before + inside}
            ranks = {k for k in ranks if before <= k < before + inside}
            if ranks:
                ranges.append(_Range(i, i, head[f"lo{i}"], head[f"hi{i}"], before, inside, ranks))

    levels: list[list[_Range]] = []
    while ranges := _unresolved(ranges, found):
        if max(r.n for r in ranges) <= sort_rows:
            _sort_ranges(narrow, levels, ranges, bins, found)
            break
        levels.append(ranges)
        ranges = _split_ranges(narrow, levels, bins)

    result: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        n = head[f"n{i}"]
        if n == 0:
            result[c] = [None] * len(probs)
            continue
        row = []
        for p in probs:
            low, share = _position(n, p)
            a = found[i, low]
            b = found[i, low + 1] if share else a
            row.append(a if a == b else a * (1 - share) + b * share if math.isinf(b - a) else a + (b - a) * share)
        result[c] = row
    return result


@dataclass
class _Range:
    """Values of one column in ``[low, high]``: ``n`` of them, after ``before`` smaller ones."""

    column: int
    code: int
    low: float
    high: float
    before: int
    n: int
    ranks: set[int]
    stretch: bool = False


def _unresolved(ranges: list[_Range], found: dict) -> list[_Range]:
    rest = []
    for r in ranges:
        left = set()
        for k in r.ranks:
            if r.low == r.high or k == r.before:
                found[r.column, k] = r.low
            elif k == r.before + r.n - 1:
                found[r.column, k] = r.high
            else:
                left.add(k)
        if left:
            rest.append(_Range(r.column, r.code, r.low, r.high, r.before, r.n, left, r.stretch))
    return rest


def _binned(narrow: DataFrame, levels: list[list[_Range]], bins: int) -> DataFrame:
    """Rows (s, v, code) inside the ranges of the last level; s is the range, code its bin.

    The first level is plain arithmetic on every row. Deeper levels see only the rows of
    the wanted bins, found by a hash set of codes, and learn their limits from a tiny
    broadcast table (at most two ranges per column and quantile).
    """
    def code(seg: Column, v: Column, low: Column, high: Column, stretch: Column | None = None) -> Column:
        return (seg * bins + _bin_of(v, low, high, bins, stretch)).alias("code")

    hits = [F.struct(F.lit(s).cast("bigint").alias("s"), F.col(f"v{r.column}").alias("v"),
                     code(F.lit(s).cast("bigint"), F.col(f"v{r.column}"), F.lit(r.low), F.lit(r.high)))
            for s, r in enumerate(levels[0])]
    # Plain explode and filter: array_compact leaves generated code and is five times slower.
    e = (narrow.select(F.explode(F.array(*hits)).alias("e")).select("e.*").filter(F.col("v").isNotNull()))
    for ranges in levels[1:]:
        table = small_table(narrow.sparkSession, 
            [(r.code, s, r.low, r.high, r.stretch) for s, r in enumerate(ranges)],
            "code bigint, t bigint, low double, high double, stretch boolean")
        e = (e.filter(F.col("code").isin([r.code for r in ranges])).join(F.broadcast(table), "code")
             .select(F.col("t").alias("s"), "v", code(F.col("t"), F.col("v"), F.col("low"), F.col("high"), F.col("stretch"))))
    return e


def _split_ranges(narrow: DataFrame, levels: list[list[_Range]], bins: int) -> list[_Range]:
    rows = (_binned(narrow, levels, bins).groupBy("code")
            .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect())
    result, before, last = [], 0, None
    for row in sorted(rows, key=lambda x: x["code"]):
        parent = levels[-1][row["code"] // bins]
        if parent is not last:
            before, last = parent.before, parent
        inside = {k for k in parent.ranks if before <= k < before + row["n"]}
        if inside:
            little = row["n"] > 0.5 * parent.n and not parent.stretch
            result.append(_Range(parent.column, row["code"], row["low"], row["high"], before, row["n"], inside, little))
        before += row["n"]
    return result


def _sort_ranges(narrow: DataFrame, levels: list, ranges: list[_Range], bins: int, found: dict) -> None:
    entries = _binned(narrow, [*levels, ranges], bins)
    running = Window.partitionBy("s").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    counts = (entries.groupBy("s", "v").agg(F.count("*").alias("n"))
              .withColumn("upto", F.sum("n").over(running)))
    targets = small_table(narrow.sparkSession, 
        [(s, [k - r.before for k in sorted(r.ranks)]) for s, r in enumerate(ranges)],
        "s bigint, targets array<bigint>")
    hit = F.exists("targets", lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n")))
    for row in counts.join(F.broadcast(targets), "s").filter(hit).collect():
        r = ranges[row["s"]]
        for k in r.ranks:
            if row["upto"] - row["n"] <= k - r.before < row["upto"]:
                found[r.column, k] = row["v"]


def rank_splits(df: DataFrame, columns: Sequence[str], rows: int, rows_per_bucket: int) -> list[list[float]]:
    """Inner range boundaries per column; empty when the data fits one bucket."""
    buckets = -(-rows // rows_per_bucket)
    if buckets <= 1:
        return [[] for _ in columns]
    probs = [b / buckets for b in range(1, buckets)]
    found = df.approxQuantile(list(columns), probs, 0.5 / buckets)
    return [sorted(set(s)) for s in found]


def value_ranks(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                flags: Mapping[str, Column] | None = None,
                rows_per_bucket: int = ROWS_PER_BUCKET, flags_before: bool = False) -> DataFrame:
    """Rank table: ``*by, column, value, n, *flags, before``.

    ``before`` counts the non-null values of the same column (and group) below ``value``;
    ``n`` counts the value itself and every flag the rows where it holds. The average
    rank of a value is ``before + (n + 1) / 2``. With ``flags_before`` the same is counted over
    the rows of each flag alone, as ``before_<flag>``.
    """
    columns, by, flags = list(columns), list(by), dict(flags or {})
    names = [f"v{i}" for i in range(len(columns))]
    narrow = df.select(*[F.col(f"`{b}`").alias(b) for b in by],
                       *[F.coalesce(c, F.lit(False)).cast("bigint").alias(f) for f, c in flags.items()],
                       *[number(df, c).alias(n) for c, n in zip(columns, names)])
    rows = narrow.count()
    splits = rank_splits(narrow, names, rows, rows_per_bucket)
    bucketed = any(splits)
    if bucketed:
        bounds = [[-math.inf, *s, math.inf] if s else [-math.inf, 0.0, math.inf] for s in splits]
        narrow = Bucketizer(splitsArray=bounds, inputCols=names, handleInvalid="keep",
                            outputCols=[f"b{i}" for i in range(len(names))]).transform(narrow)
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(n).alias("value"),
                 (F.col(f"b{i}").cast("int") if bucketed else F.lit(0)).alias("bucket"))
        for i, (c, n) in enumerate(zip(columns, names))])
    long = (narrow.select(*by, *flags, F.explode(entries).alias("e"))
            .select(*by, *flags, "e.*").filter(F.col("value").isNotNull()))
    # -0.0 and 0.0 group together but print differently; adding 0.0 makes them one value.
    long = long.withColumn("value", F.col("value") + F.lit(0.0))
    counts = (long.groupBy(*by, "column", "bucket", "value")
              .agg(F.count("*").alias("n"), *[F.sum(f).alias(f) for f in flags]))
    inside = (Window.partitionBy(*by, "column", "bucket").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, 0))
    below = {"before": "n"} | ({f"before_{f}": f for f in flags} if flags_before else {})
    ranked = counts.withColumns({c: F.sum(n).over(inside) - F.col(n) for c, n in below.items()})
    if bucketed:
        earlier = (Window.partitionBy(*by, "column").orderBy("bucket")
                   .rowsBetween(Window.unboundedPreceding, -1))
        held = {c: F.count("*") if n == "n" else F.sum(n) for c, n in below.items()}
        offsets = (long.groupBy(*by, "column", "bucket").agg(*[v.alias(f"in_{c}") for c, v in held.items()])
                   .select(*by, "column", "bucket", *[F.coalesce(F.sum(f"in_{c}").over(earlier), F.lit(0)).alias(f"offset_{c}") for c in below]))
        match = [ranked[k].eqNullSafe(offsets[k]) for k in by]
        match += [ranked[k] == offsets[k] for k in ("column", "bucket")]
        joined = ranked.join(offsets, match, "inner")
        ranked = joined.select(*[ranked[k] for k in by], ranked["column"], ranked["bucket"], ranked["value"],
                               ranked["n"], *[ranked[f] for f in flags],
                               *[(ranked[c] + offsets[f"offset_{c}"]).alias(c) for c in below])
    return ranked.drop("bucket")


def average_rank() -> Column:
    return F.col("before") + (F.col("n") + 1) / 2


def group_quantiles(df: DataFrame, columns: Sequence[str], by: Sequence[str],
                    probs: Sequence[float] = (0.5,),
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact quantiles per group: ``*by, column, n, q0, q1, ...`` (groups with a value only)."""
    by = list(by)
    ranks = value_ranks(df, columns, by, rows_per_bucket=rows_per_bucket)
    sizes = ranks.groupBy(*by, "column").agg(F.sum("n").alias("total"))
    s = sizes.select(*[F.col(k).alias(f"s_{k}") for k in by], F.col("column").alias("s_column"), "total")
    match = [ranks[k].eqNullSafe(s[f"s_{k}"]) for k in by] + [ranks["column"] == s["s_column"]]
    joined = ranks.join(s, match, "inner")
    picks, finals = [], []
    for i, p in enumerate(probs):
        exact = (F.col("total") - 1) * F.lit(float(p))
        low = F.floor(exact)
        for side, rank in (("a", low), ("b", F.least(low + 1, F.col("total") - 1))):
            here = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"{side}{i}"))
        share = (F.col("total") - 1) * F.lit(float(p)) - F.floor((F.col("total") - 1) * F.lit(float(p)))
        finals.append((F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * share).alias(f"q{i}"))
    return (joined.groupBy(*by, "column", "total").agg(*picks)
            .select(*by, "column", F.col("total").alias("n"), *finals))


def cut_or_quantiles(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], out: str) -> DataFrame:
    """``df`` with the band of ``column`` between ``edges``, or between exact quantiles if the edges collapse.

    Edges collapse if they do not increase, as when the last one is the data's maximum and lies
    below a fixed one. Then the bands are those of the median and equal shares above it: for three
    labels up to the median, up to the upper quartile, and beyond. A column without a number has no band.
    """
    if all(a < b for a, b in zip(edges, edges[1:])):
        return df.withColumn(out, cut(number(df, column), list(edges), list(labels)))
    shares = [0.5 + 0.5 * i / (len(labels) - 1) for i in range(len(labels) - 1)]
    found = exact_quantiles(df.select(number(df, column).alias("v")), ["v"], shares)["v"]
    if found[0] is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    bands = F.lit(labels[-1])
    for q, label in reversed(list(zip(found, labels))):
        bands = F.when(number(df, column) <= q, F.lit(label)).otherwise(bands)
    return df.withColumn(out, F.when(number(df, column).isNotNull(), bands))
