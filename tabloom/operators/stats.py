"""Association measures and hypothesis tests from distributed counts and ranks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.numbers import number
from tabloom.operators.columns import columns_by_kind, q
from tabloom.operators.ranks import ROWS_PER_BUCKET, average_rank, value_ranks
from tabloom.session import BROADCAST_ROWS, cut_lineage, fits, small_table


# ---- correlation ------------------------------------------------------------

def pearson_pairs(df: DataFrame, columns: Sequence[str], threshold: float | None = 0.92) -> DataFrame:
    """Correlation of every column pair in one aggregate; rows with a null on either side are skipped."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(number(df, a), number(df, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    parts = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
             for i, (a, b) in enumerate(pairs)]
    table = wide.select(F.explode(F.array(*parts)).alias("e")).select("e.*")
    return table if threshold is None else table.filter(F.abs("r") > threshold)


def spearman_matrix(df: DataFrame, columns: Sequence[str], key: Sequence[str],
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rank correlation of every pair over the rows where both are present.

    Each value of a column gets one rank over all its rows, and one over the rows where each
    column with nulls is present; so a row carries an entry per column, not one per pair. The
    ranks go back to the rows by value (a small rank table is broadcast, a large one is shuffled
    with the frequent values split off), and the tasks return one sum per pair.
    """
    columns, key = list(columns), list(key)
    p = len(columns)
    narrow = df.select(*[q(k) for k in key], *[number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    n = narrow.agg(F.count("*").alias("rows"), *[F.count(f"c{i}").alias(f"n{i}") for i in range(p)]).first()
    # Place of a partner in a value's list of ranks: partners without nulls share the first.
    place, flags = [0] * p, {}
    for i in range(p):
        if n[f"n{i}"] < n["rows"]:
            flags[f"p{len(flags)}"] = F.col(f"c{i}").isNotNull()
            place[i] = len(flags)
    names = [f"c{i}" for i in range(p)]
    table = value_ranks(narrow, names, flags=flags, rows_per_bucket=rows_per_bucket, flags_before=True)
    lists = [("n", "before"), *[(f, f"before_{f}") for f in flags]]
    ranks = cut_lineage(table.select("column", "value", "n", F.array(*[F.col(m) for m, _ in lists]).alias("sizes"),
                                     F.array(*[F.col(b) + (F.col(m) + 1) / 2 for m, b in lists]).alias("rank")))
    sizes = {r["column"]: list(r)[1:] for r in ranks.groupBy("column").agg(
        *[F.sum(F.col("sizes")[t]).alias(f"s{t}") for t in range(len(lists))]).collect()}
    both = np.array([[sizes[c][place[j]] if c in sizes else 0 for j in range(p)] for c in names], dtype=float)
    long = (narrow.select(*key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names])).alias("e"))
            .select(*key, "e.*").filter(F.col("value").isNotNull()).withColumn("value", F.col("value") + F.lit(0.0)))
    ranked = rank_lookup(long, ranks, key, n["rows"])
    at = F.substring("column", 2, 9).cast("int").alias("i")
    rows = ranked.groupBy(*key).agg(F.collect_list(F.struct(at, F.col("rank").alias("r"))).alias("e")).select("e")
    found = {(r["i"], r["j"]): (r["xy"], r["xx"]) for r in rows.mapInArrow(_rank_products(both, place), "i int, j int, xy double, xx double")
             .groupBy("i", "j").agg(F.sum("xy").alias("xy"), F.sum("xx").alias("xx")).collect()}
    out = []
    for i, j in ((i, j) for i in range(p) for j in range(p)):
        xy, scale = found.get((i, j), (0.0, 0.0))[0], found.get((i, j), (0.0, 0.0))[1] * found.get((j, i), (0.0, 0.0))[1]
        rho = xy / math.sqrt(scale) if scale > 0 else None
        out.append((columns[i], columns[j], (1.0 if n[f"n{i}"] else None) if i == j else rho))
    return small_table(df.sparkSession, out, "a string, b string, rho double")


# Doubles that one step of the rank products takes.
CUBE = 4_000_000


def _rank_products(both: np.ndarray, place: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over rows of (rank of i - mean) x (rank of j - mean), and of the first one's square, among the rows with both.

    A row is the list of (column, its ranks by partner) of its non-null columns; the mean rank of
    m rows is (m + 1) / 2, ties or not.
    """
    p = len(place)
    middle = (both + 1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xy, xx = np.zeros((p, p)), np.zeros((p, p))
        step = max(1, CUBE // (p * p))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.column(0).slice(start, step)
                entries = part.flatten()
                row = np.repeat(np.arange(len(part)), pc.list_value_length(part).to_numpy(zero_copy_only=False))
                ranks = entries.field("r").flatten().to_numpy(zero_copy_only=False).reshape(len(entries), -1)
                cube = np.full((len(part), p, p), np.nan)
                cube[row, entries.field("i").to_numpy(zero_copy_only=False)] = ranks[:, place] - middle[entries.field("i").to_numpy(zero_copy_only=False)]
                other = cube.transpose(0, 2, 1)
                here = ~(np.isnan(cube) | np.isnan(other))
                mine = np.where(here, cube, 0.0)
                xy += (mine * np.where(here, other, 0.0)).sum(axis=0)
                xx += (mine * mine).sum(axis=0)
        i, j = (a.ravel().astype(np.int32) for a in np.indices((p, p)))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(xy.ravel()), pa.array(xx.ravel())], names=["i", "j", "xy", "xx"])

    return run


def rank_lookup(long: DataFrame, ranks: DataFrame, key: Sequence[str], rows: int,
                max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """Give rows (key, column, value) their rank. Values that many rows share never meet in one task."""
    table = ranks.select("column", "value", "rank")
    if fits(table, max_broadcast):
        return long.join(F.broadcast(table), ["column", "value"])
    # A value is frequent from rows/1000 rows on, so each column has at most 1000 of them.
    limit = max(rows // 1000, 1000)
    frequent = ranks.filter(F.col("n") >= limit).select("column", "value", F.col("rank").alias("hot_rank"))
    rare = ranks.filter(F.col("n") < limit).select("column", "value", "rank", F.lit(0).cast("bigint").alias("salt"))
    marked = long.join(F.broadcast(frequent), ["column", "value"], "left")
    spread = F.when(F.col("hot_rank").isNull(), F.lit(0).cast("bigint")).otherwise(
        F.xxhash64(*[q(k) for k in key], F.lit(1)))
    joined = marked.withColumn("salt", spread).join(rare, ["column", "value", "salt"], "left")
    return joined.withColumn("rank", F.coalesce("hot_rank", "rank")).drop("hot_rank", "salt")


# ---- contingency ------------------------------------------------------------

def _pair_cells(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Joint counts (pair, u, v, o) of all pairs from one scan, combined in each task first.

    Stored, since the marginals and the statistic read them again.
    """
    names = sorted({c for p in pairs for c in p})
    at = {c: f"k{i}" for i, c in enumerate(names)}
    text = df.select(*[q(c).cast("string").alias(at[c]) for c in names])
    entries = F.array(*[F.struct(F.lit(i).alias("pair"), F.col(at[a]).alias("u"), F.col(at[b]).alias("v"))
                        for i, (a, b) in enumerate(pairs)])
    return cut_lineage(text.select(F.explode(entries).alias("e")).select("e.*")
                       .filter(F.col("u").isNotNull() & F.col("v").isNotNull())
                       .groupBy("pair", "u", "v").agg(F.count("*").alias("o")))


def _pair_chi2(cells: DataFrame) -> DataFrame:
    """pair, n, r, k, chi2 with chi2 = n (sum o^2 / (row x column) - 1).

    Two aggregates and a join on (pair, v): no window, so neither side's level count matters.
    """
    columns = cells.groupBy("pair", "v").agg(F.sum("o").alias("cs"))
    width = columns.groupBy("pair").agg(F.count("*").alias("k"))
    rows = (cells.join(columns, ["pair", "v"]).groupBy("pair", "u")
            .agg(F.sum(F.col("o").cast("double") * F.col("o") / F.col("cs")).alias("w"), F.sum("o").alias("rs")))
    return (rows.groupBy("pair").agg(F.sum("rs").alias("n"), F.count("*").alias("r"),
                                     F.sum(F.col("w") / F.col("rs")).alias("total"))
            .join(width, "pair")
            .select("pair", "n", "r", "k",
                    F.greatest(F.col("n") * (F.col("total") - 1), F.lit(0.0)).alias("chi2")))


def columns_within_levels(df: DataFrame, columns: Sequence[str], max_levels: int) -> list[str]:
    """Columns with at most ``max_levels`` distinct values, exactly.

    A sketch drops columns that are far above the limit, so only short level lists are counted.
    """
    columns = list(columns)
    rough = df.agg(*[F.approx_count_distinct(q(c), 0.02).alias(f"a{i}") for i, c in enumerate(columns)]).first()
    near = [c for i, c in enumerate(columns) if rough[f"a{i}"] <= 2 * max_levels + 10]
    if not near:
        return []
    entries = F.array(*[F.struct(F.lit(c).alias("c"), q(c).cast("string").alias("v")) for c in near])
    sizes = (df.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("v").isNotNull()).distinct()
             .groupBy("c").agg(F.count("*").alias("n")).collect())
    count = {r["c"]: r["n"] for r in sizes}
    return [c for c in near if count.get(c, 0) <= max_levels]


def cramers_v(df: DataFrame, columns: Sequence[str], max_levels: int = 30) -> DataFrame:
    """Bias-corrected Cramer's V of every column pair: a, b, v (both orders and the diagonal)."""
    usable = columns_within_levels(df, columns, max_levels)
    pairs = list(combinations(usable, 2))
    names = small_table(df.sparkSession, [(i, a, b) for i, (a, b) in enumerate(pairs)],
                        "pair int, a string, b string")
    diagonal = small_table(df.sparkSession, [(c, c, 1.0) for c in usable], "a string, b string, v double")
    if not pairs:
        return diagonal
    facts = _pair_chi2(_pair_cells(df, pairs))
    n1, r1, k1 = F.col("n") - 1, F.col("r") - 1, F.col("k") - 1
    many = F.col("n") > 1
    phi = F.when(many, F.greatest(F.lit(0.0), F.col("chi2") / F.col("n") - F.try_divide(k1 * r1, n1))).otherwise(0.0)
    rc = F.when(many, F.col("r") - F.try_divide(r1 * r1, n1)).otherwise(F.col("r").cast("double"))
    kc = F.when(many, F.col("k") - F.try_divide(k1 * k1, n1)).otherwise(F.col("k").cast("double"))
    low = F.least(rc - 1, kc - 1)
    value = F.when(low > 0, F.sqrt(phi / low))
    half = names.join(facts, "pair", "left").select("a", "b", value.alias("v"))
    return half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "v")).unionByName(diagonal)


# ---- p-values (one number per test, not per row) ------------------------------

def chi2_tail(x: float, dof: int) -> float:
    """Upper tail of the chi-square law: regularised incomplete gamma by series or fraction."""
    if dof <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    if z <= 0:
        return 1.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1.0 - front * total)
    b, c = z + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or 1e-300)
        c = (b + an / c) or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, front * h)


def fisher_p(a: int, b: int, c: int, d: int) -> float:
    """Two-sided exact p of a 2x2 table: all tables no likelier than the observed one.

    The weights fall away from the mode on both sides, so each tail stops once its terms
    no longer count; the cost does not grow with the table total.
    """
    row, col, n = a + b, a + c, a + b + c + d
    low, high = max(0, row + col - n), min(row, col)

    def log_w(x: int) -> float:
        return -(math.lgamma(x + 1) + math.lgamma(row - x + 1) + math.lgamma(col - x + 1)
                 + math.lgamma(n - row - col + x + 1))

    mode = min(high, max(low, (row + 1) * (col + 1) // (n + 2)))
    top = log_w(mode)

    def tail(start: int, step: int) -> float:
        total, x = 0.0, start
        while low <= x <= high:
            w = math.exp(log_w(x) - top)
            total += w
            if w < total * 1e-17 or (w == 0.0):
                break
            x += step
        return total

    everything = tail(mode, 1) + tail(mode - 1, -1)
    limit = log_w(a) + 1e-7

    def first(start: int, end: int, step: int) -> int | None:
        """Nearest x to the mode, going outwards, whose weight is at most the observed one."""
        if start * step > end * step or log_w(end) > limit:
            return None
        lo, hi = start, end
        while lo != hi:
            mid = (lo + hi) // 2 if step > 0 else -((-lo - hi) // 2)
            if log_w(mid) <= limit:
                hi = mid
            else:
                lo = mid + step
        return lo

    right, left = first(mode, high, 1), first(mode - 1, low, -1)
    p = (tail(right, 1) if right is not None else 0.0) + (tail(left, -1) if left is not None else 0.0)
    return min(1.0, p / everything)


def mann_whitney_p(u: float, n1: int, n2: int, ties: float) -> float:
    """Two-sided p: exact counts for a tiny group without ties, else normal with ties and continuity."""
    if ties == 0 and min(n1, n2) <= 8:
        small, large = sorted((int(n1), int(n2)))
        beyond = small * large - math.ceil(max(u, n1 * n2 - u))  # the law is symmetric
        return min(1.0, 2 * _u_at_most(small, large, beyond) / math.comb(small + large, small))
    n = n1 + n2
    var = n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1)))
    if var <= 0:
        return 1.0
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / math.sqrt(var)
    return min(1.0, math.erfc(z / math.sqrt(2)))


@cache
def _u_series(n1: int) -> tuple[int, list[int]]:
    """L and the polynomial N with 1 / ((1 - q)(1 - q)(1 - q^2)...(1 - q^n1)) = N(q) / (1 - q^L)^(n1 + 1)."""
    period, poly = math.lcm(*range(1, n1 + 1)), [1]
    for i in (1, *range(1, n1 + 1)):
        wide = [0] * (len(poly) + period - i)
        for at, c in enumerate(poly):
            for k in range(at, at + period, i):
                wide[k] += c
        poly = wide
    return period, poly


def _u_at_most(n1: int, n2: int, k: int) -> int:
    """Number of orderings of n1 and n2 values with U <= k, whatever the size of n2.

    Coefficients of the Gaussian binomial: its numerator is a sum over subsets of the n1
    factors 1 - q^(n2 + i), and each term is a cumulative count of partitions, which the
    series gives in a few products.
    """
    period, poly = _u_series(n1)

    def partitions(m: int) -> int:
        return sum(poly[j] * math.comb((m - j) // period + n1, n1) for j in range(m % period, min(len(poly) - 1, m) + 1, period)) if m >= 0 else 0

    total = 0
    for chosen in range(1 << n1):
        shift = sum(n2 + i + 1 for i in range(n1) if chosen >> i & 1)
        total += (-1) ** chosen.bit_count() * partitions(k - shift)
    return total


# ---- tests --------------------------------------------------------------------

def mann_whitney(df: DataFrame, columns: Sequence[str], target: str, first, second,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """feature, n1, n2, u (of the first class) and tie term, from the columns' rank tables."""
    columns = list(columns)
    pair = df.filter(q(target).isin(first, second))
    table = value_ranks(pair, columns, flags={"g1": q(target) == F.lit(first)}, rows_per_bucket=rows_per_bucket)
    n = F.col("n").cast("double")
    sums = table.groupBy(F.col("column").alias("feature")).agg(
        F.sum("g1").alias("n1"), (F.sum("n") - F.sum("g1")).alias("n2"),
        F.sum(F.col("g1") * average_rank()).alias("r1"), F.sum(n * n * n - n).alias("ties"))
    u = F.col("r1") - F.col("n1").cast("double") * (F.col("n1") + 1) / 2
    return sums.select("feature", "n1", "n2", u.alias("u"), "ties")


def chi_square(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """feature, n, stat, dof, cramers_v (uncorrected) of every column against the target."""
    pairs = [(c, target) for c in columns]
    names = small_table(df.sparkSession, list(enumerate(columns)), "pair int, feature string")
    v = F.sqrt(F.col("chi2") / F.col("n") / F.greatest(F.lit(1), F.least(F.col("r") - 1, F.col("k") - 1)))
    return names.join(_pair_chi2(_pair_cells(df, pairs)), "pair").select(
        "feature", "n", "r", "k", F.col("chi2").alias("stat"), ((F.col("r") - 1) * (F.col("k") - 1)).alias("dof"),
        v.alias("cramers_v"))


def fisher_cells(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """feature and the four cells of each 2x2 table, levels in text order, and the odds ratio."""
    cells = _pair_cells(df, [(c, target) for c in columns])
    names = small_table(df.sparkSession, list(enumerate(columns)), "pair int, feature string")
    ends = cells.groupBy("pair").agg(F.min("u").alias("u0"), F.min("v").alias("v0"))
    both = cells.join(ends, "pair")

    def cell(first_u: bool, first_v: bool):
        cu = (F.col("u") == F.col("u0")) if first_u else (F.col("u") != F.col("u0"))
        cv = (F.col("v") == F.col("v0")) if first_v else (F.col("v") != F.col("v0"))
        return F.coalesce(F.sum(F.when(cu & cv, F.col("o"))), F.lit(0))

    grid = both.groupBy("pair").agg(cell(True, True).alias("a"), cell(True, False).alias("b"),
                                    cell(False, True).alias("c"), cell(False, False).alias("d"))
    odds = F.try_divide(F.col("a").cast("double") * F.col("d"), F.col("b").cast("double") * F.col("c"))
    infinite = (F.col("a") * F.col("d") > 0) & (F.col("b").cast("double") * F.col("c") == 0)
    return names.join(grid, "pair").select(
        "feature", "a", "b", "c", "d",
        F.when(infinite, F.lit(float("inf"))).otherwise(odds).alias("odds_ratio"))


def battery(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One test per column against the target, chosen by type, sorted by p (nulls last).

    Numeric columns: Mann-Whitney for a two-class target. Boolean and text columns: Fisher
    for two levels on both sides, else chi-square. Three scans in all, however many columns.
    """
    kinds = columns_by_kind(df)
    columns = [c for c in (columns or df.columns) if c != target]
    present = df.agg(*[F.count(q(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    columns = [c for i, c in enumerate(columns) if present[f"n{i}"]]
    numeric = [c for c in columns if c in kinds["numeric"]]
    discrete = [c for c in columns if c in kinds["boolean"] + kinds["categorical"]]
    # sorted() of at most three levels decides between two classes and anything else.
    classes = sorted(r[0] for r in df.filter(q(target).isNotNull()).select(q(target)).distinct().limit(3).collect())
    rows: dict[str, tuple] = {}
    if numeric and len(classes) == 2:
        for r in mann_whitney(df, numeric, target, *classes).collect():
            if r["n1"] and r["n2"]:
                p = mann_whitney_p(r["u"], r["n1"], r["n2"], r["ties"])
                rows[r["feature"]] = (r["feature"], "Mann-Whitney U", r["n1"] + r["n2"], r["u"], p, None, None, None, None)
    for c in numeric:
        note = "target not binary" if len(classes) != 2 else "empty groups"
        rows.setdefault(c, (c, "Mann-Whitney U", None, None, None, None, None, note, None))
    if discrete:
        small, facts = [], {r["feature"]: r for r in chi_square(df, discrete, target).collect()}
        for c in discrete:
            r = facts.get(c)
            if r is None:
                rows[c] = (c, "Chi-square", None, None, None, None, None, None, "no common rows")
            elif r["r"] == 2 and r["k"] == 2:
                small.append(c)
            else:
                rows[c] = (c, "Chi-square", r["n"], r["stat"], chi2_tail(r["stat"], r["dof"]), r["dof"],
                           r["cramers_v"], None, None)
        if small:
            for r in fisher_cells(df, small, target).collect():
                cells = (r["a"], r["b"], r["c"], r["d"])
                rows[r["feature"]] = (r["feature"], "Fisher exact (2x2)", sum(cells), r["odds_ratio"],
                                      fisher_p(*cells), None, None, None, None)
    for c in columns:
        rows.setdefault(c, (c, "Unsupported dtype", None, None, None, None, None, None, None))
    table = small_table(df.sparkSession, [rows[c] for c in columns],
                        "feature string, test string, n bigint, stat double, p_value double, dof bigint, "
                        "cramers_v double, note string, test_error string")
    return table.orderBy(F.col("p_value").asc_nulls_last(), "feature")


def significant(tests: DataFrame, level: float = 0.05) -> DataFrame:
    return tests.filter(F.col("p_value") < level)
