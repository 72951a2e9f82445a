"""Equi-, lookup- and box joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.text import value_map
from tabloom.operators.columns import q
from tabloom.session import BROADCAST_ROWS, fits

# Rough area boxes (latitude range, longitude range); they overlap.
AREA_BOXES = {
    "Staten Island": ((40.48, 40.65), (-74.26, -74.05)),
    "Brooklyn": ((40.56, 40.74), (-74.05, -73.85)),
    "Queens": ((40.55, 40.80), (-73.96, -73.70)),
    "Manhattan": ((40.69, 40.88), (-74.03, -73.92)),
    "Bronx": ((40.80, 40.92), (-73.93, -73.76)),
}


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; aggregated map-side, so a hot key is no problem."""
    rest = [c for c in df.columns if c not in keys]
    # min over a struct compares field by field; order columns lead, the others break ties, and
    # a flag before each field puts nulls last.
    fields = [*order, *[c for c in rest if c not in order]]
    flagged = [x for i, c in enumerate(fields) for x in (q(c).isNull().alias(f"_null{i}"), q(c))]
    best = df.groupBy(*[q(k) for k in keys]).agg(F.min(F.struct(*flagged)).alias("_first"))
    return best.select(*[q(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])


def inner_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equally named keys; sizes decide the strategy at run time (AQE)."""
    return left.join(right, list(keys), "inner")


def lookup_left(left: DataFrame, lookup: DataFrame, left_key: str, lookup_key: str,
                values: Sequence[str], max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """Left join to a lookup that is first reduced to one row per key; null matches nothing.

    A checked small lookup is broadcast. A larger one is shuffled, and rows with a null
    key, which match nothing but would all meet in one task, go around the join.
    """
    wanted = lookup.select(q(lookup_key).alias("_k"), *[q(v) for v in values]).filter(F.col("_k").isNotNull())
    once = keep_first(wanted, ["_k"], list(values))
    if fits(once, max_broadcast):
        return left.join(F.broadcast(once), q(left_key) == F.col("_k"), "left").drop("_k")
    keyed = left.filter(q(left_key).isNotNull())
    joined = keyed.join(once, q(left_key) == F.col("_k"), "left").drop("_k")
    missing = left.filter(q(left_key).isNull())
    for v in values:
        missing = missing.withColumn(v, F.lit(None).cast(once.schema[v].dataType))
    return joined.unionByName(missing)


def fill_from_map(df: DataFrame, column: str, key, mapping: Mapping) -> DataFrame:
    """Constant mapping as the fall-back where ``column`` is null."""
    return df.withColumn(column, F.coalesce(q(column), value_map(key, mapping)))


def box_join(points: DataFrame, lat: str, lng: str, boxes: Mapping = AREA_BOXES,
             name: str = "box") -> DataFrame:
    """One row per (point, containing box). The boxes are constants, so no join is needed."""
    y, x = q(lat), q(lng)
    hits = [F.when(y.between(*ys) & x.between(*xs), F.lit(b)) for b, (ys, xs) in boxes.items()]
    return points.withColumn(name, F.explode(F.array(*hits))).filter(F.col(name).isNotNull())


def box_counts(points: DataFrame, lat: str, lng: str, boxes: Mapping = AREA_BOXES) -> DataFrame:
    return (box_join(points.select(q(lat), q(lng)), lat, lng, boxes).groupBy("box")
            .agg(F.count("*").alias("count")).orderBy(F.desc("count"), "box"))


def with_share(counts: DataFrame, count: str = "count", within: Sequence[str] = (),
               out: str = "percent", digits: int | None = None, scale: float = 100.0) -> DataFrame:
    """Share of the total (of the group) on an already aggregated table.

    The total is one number, or one small aggregate joined back, never a window over the table.
    """
    if within:
        totals = counts.groupBy(*within).agg(F.sum(count).alias("_total"))
        joined = counts.join(totals, list(within))
    else:
        joined = counts.withColumn("_total", F.lit(counts.agg(F.sum(count)).first()[0]).cast("bigint"))
    share = F.col(count) / F.col("_total") * scale
    return joined.withColumn(out, F.round(share, digits) if digits is not None else share).drop("_total")


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """First ``k`` rows per group; Spark limits each group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
