"""Exact nearest-neighbour joins by a hierarchy of boxes.

Right points are put into nested boxes with about equally many points. Query points walk
down the hierarchy; at each level a box is dropped once other boxes are certain to hold
enough nearer points. So a query meets a few small boxes, never all points of a dense
area, and no candidate is lost: the result equals the full comparison.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.columns import add_prefix, q
from tabloom.operators.joins import keep_first
from tabloom.session import BROADCAST_ROWS, cut_lineage, fits

LEAF_POINTS = 32
# Code length per dimension; the first bits are quantiles, the rest equal steps inside them.
MAX_BITS, QUANTILE_BITS = 24, 10
# Levels at which boxes are listed, in bits per dimension.
LEVELS = [1, 2, 3, 4, 6, 8, 10, 12, 16, 20]
# A box that more queries than this reach, and than 1 / CROWDS of all, is dealt to several tasks; so there are at most CROWDS.
CROWD_ROWS, CROWDS = 100_000, 2_000
# Queries per task of the walk. A query meets up to hundreds of boxes and points, so a task is bounded by its
# queries: a share of the few bytes that the walk starts with would grow with the table.
TASK_QUERIES = 2_048
# Rounding slack of a pruning comparison; only ever keeps a box too many.
SLACK = 1e-9
DEGREE_KM = 111.0
# Search radius in km by area, and the radius of every other area.
AREA_CAPS_KM = {"Staten Island": 2.0, "Bronx": 1.2, "Brooklyn": 1.2, "Manhattan": 1.0, "Queens": 1.2}
DEFAULT_CAP_KM = 1.2


def nearest(queries: DataFrame, points: DataFrame, dims: Sequence[str], order: Sequence[str], k: int = 1,
            group: str | None = None, weight: str | None = None, radius: str | None = None,
            split_source: DataFrame | None = None, leaf_points: int = LEAF_POINTS,
            max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """The ``k`` nearest points of every query: ``group, *dims, radius, *order, d2, weight``.

    ``queries``: distinct rows (group, dims, radius). ``points``: distinct (group, dims,
    order); ``weight`` says how many equal points a row stands for (neighbours are taken
    until ``k`` are counted). Equal distances are taken in the order of ``order``.
    ``group`` must have few values (one box table row per group and first-level box).
    """
    dims, order = list(dims), list(order)
    d = len(dims)
    g = q(group) if group else F.lit(0)
    w = q(weight) if weight else F.lit(1).cast("bigint")
    r = q(radius) if radius else F.lit(None).cast("double")
    qs = queries.select(g.alias("_g"), *[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(dims)], r.alias("_r"))
    pts = points.select(g.alias("_g"), *[q(c).cast("double").alias(f"y{i}") for i, c in enumerate(dims)],
                        w.alias("_w"), F.struct(*[q(o) for o in order]).alias("_o"))
    if k > 1:
        # Of points at one place only the first k can be taken; Spark limits them before the shuffle.
        same = Window.partitionBy("_g", *[f"y{i}" for i in range(d)]).orderBy("_o")
        pts = pts.withColumn("_rn", F.row_number().over(same)).filter(F.col("_rn") <= k).drop("_rn")
    source = pts if split_source is None else split_source.select(
        *[q(c).cast("double").alias(f"y{i}") for i, c in enumerate(dims)])
    tree = _BoxTree(pts, source, d, leaf_points, max_broadcast)
    # Windows group by the hash first: Spark sees that the walk is already dealt by it and shuffles no more.
    ident = ["_h", "_g", *[f"x{i}" for i in range(d)], "_r"]
    qs = cut_lineage(qs)
    parts = max(qs.sparkSession.sparkContext.defaultParallelism, math.ceil(qs.count() / TASK_QUERIES))
    qs = qs.withColumn("_h", F.xxhash64(*ident[1:])).repartition(parts, "_h")
    candidates = None
    for above, level in zip([None, *tree.levels], tree.levels):
        boxes = tree.boxes(above, level)
        if above is None:
            # At most 2^(level x d) boxes per group: constants, or a list that is small by construction.
            if group:
                candidates = tree.joined(qs, boxes, ["_g"], ident)
            else:
                names = [c for c in boxes.columns if c != "_g"]
                roots = [F.struct(*[F.lit(b[c]).cast(boxes.schema[c].dataType).alias(c) for c in names])
                         for b in boxes.collect()]
                if not roots:
                    roots = [F.lit(None).cast(T.StructType([boxes.schema[c] for c in names]))]
                candidates = qs.withColumn("_b", F.explode(F.array(*roots))).filter(
                    F.col("_b").isNotNull()).select("*", "_b.*").drop("_b")
        else:
            candidates = tree.joined(candidates.select(*ident, *tree.renamed("p")), boxes, tree.key("p"), ident)
        candidates = _prune(candidates, ident, tree.key("c"), d, k)
    last = candidates.select(*ident, *tree.key("c")[1:])
    pairs = (last.join(F.broadcast(tree.points()), tree.key("c")) if tree.few_points
             else dealt_join(last, tree.points(), tree.key("c"), ident))
    d2 = sum((F.pow(F.col(f"x{i}") - F.col(f"y{i}"), 2) for i in range(d)), F.lit(0.0))
    pairs = pairs.select(*ident, d2.alias("d2"), "_o", "_w", *[f"y{i}" for i in range(d)])
    if radius:
        pairs = pairs.filter(F.col("d2") <= F.col("_r") * F.col("_r") * (1 + 1e-6))
    if k == 1:
        best = pairs.groupBy(*ident).agg(F.min(F.struct("d2", "_o", "_w", *[f"y{i}" for i in range(d)])).alias("m"))
        chosen = best.select(*ident, "m.*")
    else:
        w_id = Window.partitionBy(*ident).orderBy("d2", "_o")
        chosen = (pairs.withColumn("_n", F.row_number().over(w_id)).filter(F.col("_n") <= k)
                  .withColumn("_before", F.sum("_w").over(w_id.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_w"))
                  .filter(F.col("_before") < k)
                  .withColumn("_w", F.least(F.col("_w"), F.lit(k) - F.col("_before"))))
    out = [F.col(f"x{i}").alias(c) for i, c in enumerate(dims)]
    if group:
        out.insert(0, F.col("_g").alias(group))
    if radius:
        out.append(F.col("_r").alias(radius))
    return chosen.select(*out, *[F.col("_o")[o].alias(o) for o in order], "d2",
                         *([F.col("_w").alias(weight)] if weight else []),
                         *[F.col(f"y{i}").alias(f"near_{c}") for i, c in enumerate(dims)])


class _BoxTree:
    """Nested boxes over the points. A box is split until it has few points or the codes end.

    Every point has a code per dimension: its quantile bucket, refined by equal steps
    inside the bucket. A box of level l is all points that share the first l bits of
    every code. ``cells`` holds the finest boxes with the level at which each one's
    branch stops, so a box list of any level is one small aggregate.
    """

    def __init__(self, pts: DataFrame, source: DataFrame, d: int, leaf_points: int, max_broadcast: int):
        self.d, self.max_broadcast = d, max_broadcast
        pts = cut_lineage(pts)
        n = pts.count()
        self.bits = min(MAX_BITS, max(2, math.ceil(math.log2(max(n / leaf_points, 2))) + 2))
        self.pts = _coded(pts, source, d, self.bits)
        codes = [f"c{i}" for i in range(d)]
        full = cut_lineage(self.pts.groupBy("_g", *codes).agg(
            F.sum("_w").alias("_w"), F.count("*").alias("_n"),
            *[a for i in range(d) for a in (F.min(f"y{i}").alias(f"lo{i}"), F.max(f"y{i}").alias(f"hi{i}"))]))
        self.small = full.count() <= max_broadcast
        self.few_points = n <= max_broadcast
        levels = [b for b in LEVELS if b < self.bits and (d > 2 or b % 2 == 0)] + [self.bits]
        cells, stop = full, None
        for b in levels[:-1]:
            at = [F.shiftright(c, self.bits - b).alias(f"k{i}") for i, c in enumerate(codes)]
            sizes = full.groupBy(F.col("_g").alias("_kg"), *at).agg(F.sum("_n").alias(f"_n{b}"))
            match = F.col("_g") == F.col("_kg")
            for i, c in enumerate(codes):
                match = match & (F.shiftright(c, self.bits - b) == F.col(f"k{i}"))
            cells = cells.join(self.hint(sizes), match).drop("_kg", *[f"k{i}" for i in range(d)])
            few = F.col(f"_n{b}") <= leaf_points
            stop = F.when(few, F.lit(b)) if stop is None else stop.when(few, F.lit(b))
        last = F.lit(self.bits)
        self.cells = cut_lineage(cells.withColumn("stop", last if stop is None else stop.otherwise(last))
                                 .select(*full.columns, "stop"))
        deepest = self.cells.agg(F.max("stop")).first()[0] or levels[0]
        self.levels = [b for b in levels if b <= deepest]

    def hint(self, df: DataFrame) -> DataFrame:
        """Box lists are no longer than the list of the finest boxes, whose length is known."""
        return F.broadcast(df) if self.small else df

    def key(self, prefix: str) -> list[str]:
        return ["_g", f"{prefix}lvl", *[f"{prefix}{i}" for i in range(self.d)]]

    def renamed(self, prefix: str) -> list[Column]:
        return [F.col(c).alias(p) for c, p in zip(self.key("c")[1:], self.key(prefix)[1:])]

    def _at(self, level: int, prefix: str) -> list[Column]:
        """Identity of the box that holds a cell at ``level`` (or where its branch stopped above)."""
        lvl = F.least(F.col("stop"), F.lit(level))
        shift = F.lit(self.bits) - lvl
        return [lvl.alias(f"{prefix}lvl"), *[F.call_function("shiftright", F.col(f"c{i}"), shift).alias(f"{prefix}{i}")
                                             for i in range(self.d)]]

    def boxes(self, above: int | None, level: int) -> DataFrame:
        """Boxes of ``level`` with their box of the level above as the join key."""
        by = self._at(level, "b") + (self._at(above, "p") if above is not None else [])
        grouped = self.cells.select("_g", "_w", *[f"{e}{i}" for e in ("lo", "hi") for i in range(self.d)], *by)
        names = self.key("b")[1:] + (self.key("p")[1:] if above is not None else [])
        out = grouped.groupBy("_g", *names).agg(
            F.sum("_w").alias("_w"),
            *[a for i in range(self.d) for a in (F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"))])
        return out.withColumnsRenamed(dict(zip(self.key("b")[1:], self.key("c")[1:])))

    def points(self) -> DataFrame:
        """Points with the identity of their last box."""
        stops = self.cells.select("_g", *[f"c{i}" for i in range(self.d)], "stop")
        placed = self.pts.join(self.hint(stops), ["_g", *[f"c{i}" for i in range(self.d)]])
        out = placed.select("_g", "_w", "_o", *[f"y{i}" for i in range(self.d)], *self._at(self.bits, "b"))
        out = out.withColumnsRenamed(dict(zip(self.key("b")[1:], self.key("c")[1:])))
        return out

    def joined(self, queries: DataFrame, boxes: DataFrame, key: list[str], ident: list[str]) -> DataFrame:
        """Queries with the boxes below theirs. A list of boxes that passes the size check is broadcast, whatever the next levels' are."""
        if self.small or fits(boxes, self.max_broadcast):
            return queries.join(F.broadcast(boxes), key)
        return dealt_join(queries, boxes, key, ident)


def dealt_join(queries: DataFrame, table: DataFrame, key: Sequence[str], ident: Sequence[str]) -> DataFrame:
    """Inner join on ``key`` where many queries may share one: the rows of a crowded key are copied, and a
    query meets the copy that a hash of ``ident`` gives, so no task has more than a copy's share.

    Copies are as many as a key's queries need; other keys have one. The counts of crowded keys are
    a bounded list, hence a broadcast.
    """
    key = list(key)
    queries = cut_lineage(queries)
    share = max(CROWD_ROWS, queries.count() // CROWDS)
    crowded = cut_lineage(queries.groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") > share)
                          .select(*key, F.ceil(F.col("_n") / share).cast("int").alias("_copies")))
    if crowded.isEmpty():
        return queries.join(table, key)
    copies = F.coalesce("_copies", F.lit(1))
    spread = queries.join(F.broadcast(crowded), key, "left").withColumn("_copy", F.pmod(F.xxhash64(*ident), copies).cast("int")).drop("_copies")
    copied = table.join(F.broadcast(crowded), key, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies")
    return spread.join(copied, [*key, "_copy"]).drop("_copy")


def _coded(pts: DataFrame, source: DataFrame, d: int, bits: int) -> DataFrame:
    names = [f"y{i}" for i in range(d)]
    coarse = min(bits, QUANTILE_BITS)
    fine = 1 << (bits - coarse)
    parts = 1 << coarse
    found = source.approxQuantile(names, [b / parts for b in range(1, parts)], 0.25 / parts)
    ends = source.agg(*[a for c in names for a in (F.min(c), F.max(c))]).first()
    bounds = [[-math.inf, *(sorted(set(s)) or [0.0]), math.inf] for s in found]
    coded = Bucketizer(splitsArray=bounds, inputCols=names, outputCols=[f"b{i}" for i in range(d)]).transform(pts)
    codes = {}
    for i, c in enumerate(names):
        bucket = F.col(f"b{i}").cast("int")
        if fine == 1:
            codes[f"c{i}"] = bucket
            continue
        edges = F.array(*[F.lit(float(e)) for e in [ends[2 * i] or 0.0, *bounds[i][1:-1], ends[2 * i + 1] or 0.0]])
        low, high = edges[bucket], edges[bucket + 1]
        step = F.coalesce(F.floor(F.try_divide(F.col(c) - low, high - low) * fine), F.lit(0))
        codes[f"c{i}"] = (bucket * fine + F.greatest(F.lit(0), F.least(step, F.lit(fine - 1)))).cast("int")
    return coded.withColumns(codes).drop(*[f"b{i}" for i in range(d)])


def _prune(cand: DataFrame, ident: list[str], codes: list[str], d: int, k: int) -> DataFrame:
    near, far = F.lit(0.0), F.lit(0.0)
    for i in range(d):
        x, lo, hi = F.col(f"x{i}"), F.col(f"lo{i}"), F.col(f"hi{i}")
        near = near + F.pow(F.greatest(lo - x, x - hi, F.lit(0.0)), 2)
        far = far + F.pow(F.greatest(F.abs(x - lo), F.abs(x - hi)), 2)
    cand = cand.withColumns({"_near": near, "_far": far})
    cand = cand.filter(F.col("_r").isNull() | (F.col("_near") <= F.col("_r") * F.col("_r") * (1 + 1e-6)))
    whole = Window.partitionBy(*ident)
    if k == 1:
        bound = F.min("_far").over(whole)
    else:
        upto = F.sum("_w").over(whole.orderBy("_far").rangeBetween(Window.unboundedPreceding, 0))
        cand = cand.withColumn("_upto", upto)
        bound = F.min(F.when(F.col("_upto") >= k, F.col("_far"))).over(whole)
    cand = cand.withColumn("_bound", bound)
    keep = F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound") * (1 + SLACK) + 1e-300)
    return cand.filter(keep).select(*ident, *codes[1:])


def area_cap(area: Column, caps: Mapping[str, float] = AREA_CAPS_KM, default: float = DEFAULT_CAP_KM) -> Column:
    chain = None
    for name, km in caps.items():
        chain = F.when(area == name, F.lit(float(km))) if chain is None else chain.when(area == name, F.lit(float(km)))
    return chain.otherwise(F.lit(float(default))) if chain is not None else F.lit(float(default))


def located_at(*names: str) -> Column:
    """True where every coordinate is a finite number."""
    known = F.lit(True)
    for n in names:
        known = known & F.coalesce(F.abs(q(n).cast("double")) < float("inf"), F.lit(False))
    return known


def nearest_capped(left: DataFrame, right: DataFrame, left_xy: tuple[str, str], right_xy: tuple[str, str],
                   right_keys: Sequence[str], cap_km: Column, prefix: str = "FARS__",
                   distance: str = "match_distance_km", max_broadcast: int = BROADCAST_ROWS,
                   leaf_points: int = LEAF_POINTS) -> DataFrame:
    """Left join to the nearest right row within a per-row cap.

    Planar distance in degrees times 111; distance and cap are compared in single
    precision. Equal distances go to the smallest right key. Left rows without
    coordinates, and those with nothing in reach, keep nulls.
    """
    ly, lx = left_xy
    ry, rx = right_xy
    rows = left.withColumn("_cap", cap_km.cast("double"))
    located = located_at(ly, lx)
    places = (rows.filter(located).select(q(ly).cast("double").alias("_y"), q(lx).cast("double").alias("_x"),
                                          (F.col("_cap") / DEGREE_KM).alias("_reach"), "_cap").distinct())
    spots = keep_first(right.filter(located_at(ry, rx)), [ry, rx], list(right_keys))
    spots = cut_lineage(spots)
    hits = nearest(places.select("_y", "_x", "_reach").distinct(),
                   spots.select(q(ry).alias("_y"), q(rx).alias("_x"), *[q(c) for c in right_keys]),
                   ["_y", "_x"], right_keys, radius="_reach", leaf_points=leaf_points, max_broadcast=max_broadcast)
    km = (F.sqrt("d2") * DEGREE_KM).cast("float")
    details = add_prefix(spots, prefix)
    near = hits.select("_y", "_x", "_reach", km.alias(distance),
                       F.col("near__y").alias("_ry"), F.col("near__x").alias("_rx"))
    near = near.join(details, (F.col("_ry") == q(prefix + ry)) & (F.col("_rx") == q(prefix + rx))).drop("_ry", "_rx")
    near = cut_lineage(near.withColumnsRenamed({"_y": "_hy", "_x": "_hx", "_reach": "_hr"}))
    match = ((q(ly).cast("double") == F.col("_hy")) & (q(lx).cast("double") == F.col("_hx"))
             & (F.col("_cap") / DEGREE_KM == F.col("_hr")) & (q(distance) <= F.col("_cap").cast("float")))
    joined = _joined_back(rows.filter(located), near, match, (q(ly).cast("double"), q(lx).cast("double"), F.col("_cap") / DEGREE_KM), max_broadcast)
    joined = joined.drop("_hy", "_hx", "_hr", "_cap")
    return joined.unionByName(rows.filter(~located).drop("_cap"), allowMissingColumns=True)


def _joined_back(rows: DataFrame, near: DataFrame, match: Column, place: Sequence[Column], max_broadcast: int) -> DataFrame:
    """Rows with what was found for their place. Rows of crowded places, a bounded list, go around the shuffle."""
    if fits(near, max_broadcast):
        return rows.join(F.broadcast(near), match, "left")
    names = ["_py", "_px", "_pr"]
    counts = cut_lineage(rows.groupBy(*[c.alias(n) for c, n in zip(place, names)]).agg(F.count("*").alias("_n")))
    share = max(CROWD_ROWS, (counts.agg(F.sum("_n")).first()[0] or 0) // CROWDS)
    crowded = cut_lineage(counts.filter(F.col("_n") > share).select(*names))
    if crowded.isEmpty():
        return rows.join(near, match, "left")

    def at(columns: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a & b, [c == F.col(n) for c, n in zip(columns, names)])

    known = near.join(F.broadcast(crowded), at([F.col(c) for c in ("_hy", "_hx", "_hr")]), "left_semi")
    inside = rows.join(F.broadcast(crowded), at(place), "left_semi").join(F.broadcast(known), match, "left")
    outside = rows.join(F.broadcast(crowded), at(place), "left_anti").join(near, match, "left")
    return inside.unionByName(outside)
