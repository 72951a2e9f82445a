"""Frequency tables, contingency tables, set operations and sorts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import q
from tabloom.operators.joins import keep_first, with_share
from tabloom.session import broadcast_if_small, cut_lineage, small_table

MAX_PIVOT_LEVELS = 10_000


def frequency(df: DataFrame, column: str, null_label: str | None = "Missing", digits: int = 2) -> DataFrame:
    """Count and percent per level, with nulls under ``null_label`` (or kept as null)."""
    level = q(column).cast("string")
    if null_label is not None:
        level = F.coalesce(level, F.lit(null_label))
    counts = df.groupBy(level.alias(column)).agg(F.count("*").alias("count"))
    return with_share(counts, digits=digits)


def levels_of(df: DataFrame, column: str, limit: int = MAX_PIVOT_LEVELS) -> list:
    """Sorted distinct non-null values; refuses a column with more than ``limit`` of them."""
    rows = df.select(q(column).alias("v")).filter(F.col("v").isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} levels")
    return sorted(r["v"] for r in rows)


def crosstab(df: DataFrame, rows: str, columns: str, proportions: bool = False,
             digits: int | None = None, limit: int = MAX_PIVOT_LEVELS, other: str = "(other)") -> DataFrame:
    """Contingency table with one column per level of ``columns``; optionally row shares.

    Of more levels than ``limit`` the most frequent have a column (ties: the smaller level), and
    all others are counted in ``other``, so that rows still add up; ``contingency`` has every cell.
    """
    heavy = heavy_levels(df, columns, limit)
    levels = sorted(heavy[0])
    text, names = q(columns).cast("string"), [str(v) for v in levels]
    if heavy[1]:
        while other in names:
            other += "_"
        text = F.when(q(columns).isin(levels), text).when(q(columns).isNotNull(), other)
        names.append(other)
    grid = (df.select(q(rows), text.alias("_level")).groupBy(q(rows))
            .pivot("_level", names).count().na.fill(0, subset=names))
    if not proportions:
        return grid
    total = reduce(lambda a, b: a + b, [q(v) for v in names])
    share = {v: (q(v) / total if digits is None else F.round(q(v) / total, digits)) for v in names}
    return grid.select(q(rows), *[c.alias(v) for v, c in share.items()])


def heavy_levels(df: DataFrame, column: str, limit: int) -> tuple[list, bool]:
    """At most ``limit`` non-null values with the most rows, and whether there are others."""
    counts = df.filter(q(column).isNotNull()).groupBy(q(column).alias("v")).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "v").limit(limit + 1).collect()
    return [r["v"] for r in top[:limit]], len(top) > limit


def contingency(df: DataFrame, rows: str, columns: str, digits: int | None = None) -> DataFrame:
    """Every cell that occurs, whatever the number of levels: both levels, count, row_total, column_total, row_share.

    Nulls have no cell. Cells are counted before the shuffle and stored; the margins are
    aggregates of the cells that are joined back, a small one as a broadcast, so a level with
    cells beyond any task's memory is no problem either way: Spark splits the cells of a large one.
    """
    names = [rows, columns, "count"]
    cells = cut_lineage(df.filter(q(rows).isNotNull() & q(columns).isNotNull())
                        .groupBy(q(rows).alias("u"), q(columns).alias("v")).agg(F.count("*").alias("n")))
    out = cells
    for side, total in (("u", "row_total"), ("v", "column_total")):
        margin = cells.groupBy(side).agg(F.sum("n").alias(total))
        out = out.join(broadcast_if_small(margin), side)
    share = F.col("n") / F.col("row_total")
    share = share if digits is None else F.round(share, digits)
    return out.select("u", "v", "n", "row_total", "column_total", share.alias("row_share")).toDF(*names, "row_total", "column_total", "row_share")


def domain_counts(df: DataFrame, column: str, domain: Sequence) -> DataFrame:
    """Counts over a fixed domain; levels that do not occur get 0."""
    kind = df.schema[column].dataType.simpleString()
    base = small_table(df.sparkSession, [(v,) for v in domain], f"{column} {kind}")
    counts = df.groupBy(q(column)).agg(F.count("*").alias("count"))
    return base.join(counts, [column], "left").na.fill(0, subset=["count"])


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_distinct_by(tables: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_first(union_all(tables), keys, order)


def overlaps(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> bool:
    """True if two tables share a key."""
    keys = list(keys)
    return not a.select(*keys).join(b.select(*keys), keys, "left_semi").isEmpty()


def sort_rows(df: DataFrame, order: Sequence[tuple[str, str]], limit: int | None = None) -> DataFrame:
    """``order`` holds (column, "asc" | "desc"); nulls come last either way."""
    keys = [q(c).asc_nulls_last() if d == "asc" else q(c).desc_nulls_last() for c, d in order]
    ordered = df.orderBy(*keys)
    return ordered.limit(limit) if limit is not None else ordered


def best_row(df: DataFrame, by: str) -> dict:
    """The row with the smallest value of ``by``."""
    fields = [c for c in df.columns if c != by]
    row = df.filter(q(by).isNotNull()).agg(
        F.min(F.struct(q(by), *[q(c) for c in fields])).alias("best")).first()["best"]
    if row is None:
        raise ValueError(f"no row with a value in {by}")
    return row.asDict()


def class_sentiment_summary(df: DataFrame, by: str, polarity: str = "polarity",
                            subjectivity: str = "subjectivity", sentiment: str = "sentiment") -> DataFrame:
    """Rows, means and the counts and percents of the three signs per class, in one aggregate."""
    n = F.count("*")
    out = [n.alias("n_rows"), F.avg(q(polarity)).alias("mean_polarity"),
           F.avg(q(subjectivity)).alias("mean_subjectivity")]
    for sign, label in ((-1, "neg"), (0, "neu"), (1, "pos")):
        hits = F.count_if(q(sentiment) == sign)
        out += [hits.alias(f"{label}_count"), F.round(hits / n * 100, 2).alias(f"{label}_pct")]
    return df.groupBy(q(by)).agg(*out)
