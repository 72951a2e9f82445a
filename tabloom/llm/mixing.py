"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import in_batches, saved, whole
from tabloom.session import broadcast_if_small

#: Weights of the sources in code point order (a missing source comes last), repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and how often a source may be taken at most.
SHARE, MOST = 1.5, 2.0
SEED = 20
#: Expected copies are whole multiples of 1 / UNIT, so that prefix sums are exact integers.
UNIT = 1 << 24


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    The budget is shared by weight; a source stops at ``most`` times its size and its excess goes
    to the others. In order of size over weight the sources that stop come first, so prefix sums
    give the level at which the rest share: the first source whose level is within its own bound.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    listed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("long"))
    order = Window.orderBy("ratio", F.asc_nulls_last("source"))
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    ranked = listed.withColumn("ratio", F.lit(most) * F.col("source_size") / F.col("weight")).withColumn(
        "level", (F.lit(share) * F.sum("source_size").over(Window.partitionBy()) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(onward))
    within = F.col("level") <= F.col("ratio")
    found = F.min_by(F.when(within, F.col("level")), F.when(within, F.col("ratio"))).over(Window.partitionBy())
    return ranked.select("source", "source_size", F.least(F.lit(most) * F.col("source_size"), F.col("weight") * found).alias("target"))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sum of ``units`` inside each source of a sorted partition (its rows stand together)."""
    source, total = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        units = batch.column("units").to_numpy()
        places = batch.column("place").to_numpy()
        sums = np.cumsum(units)
        starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        base = np.where(starts > 0, sums[starts - 1], 0)
        carry = np.zeros(len(starts), dtype=np.int64)
        carry[0] = total if places[0] == source else 0
        sums = sums - np.repeat(base - carry, np.diff(np.r_[starts, len(units)]))
        source, total = places[-1], int(sums[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, type=pa.int64())], names=[*batch.schema.names, "sums"])


def systematic_copies(rows: DataFrame, units: str, group: str, order: list[Column], seed: int = SEED) -> DataFrame:
    """``rows`` with ``copies``: how many integer boundaries the group's prefix sum of expected copies crosses at the row.

    ``units`` names a long column of expected copies times UNIT. Each group gets one offset, drawn
    from the seed and its name, so reruns agree. Rows are range-partitioned by group and order, so
    a group of any share of the rows spreads over partitions; a partition sums its own rows, and
    the sums of the partitions before it are added from a table of one row per partition and group.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_last(group), *order]
    dealt = rows.withColumn("units", F.col(units)).repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("part", F.spark_partition_id()).withColumn("place", F.coalesce(F.xxhash64(group), F.lit(0)) + F.isnull(group).cast("long"))
    schema = dealt.withColumn("sums", F.lit(0).cast("long")).schema
    held = saved(in_batches(dealt, _running, schema), "mix-sums")
    per = held.groupBy("part", group).agg(F.max("sums").alias("sum"))
    prior = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(F.col("part").alias("at"), F.col(group).alias("of"), F.coalesce(F.sum("sum").over(prior), F.lit(0)).alias("offset"))
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(group), F.lit("")))), 1, 6), 16, 10).cast("long")
    joined = held.join(broadcast_if_small(offsets), (F.col("part") == F.col("at")) & F.col(group).eqNullSafe(F.col("of")))
    upto = joined.withColumn("upto", F.col("offset") + F.col("sums") + start)
    return upto.withColumn("copies", F.expr(f"upto div {UNIT} - (upto - units) div {UNIT}")).drop("part", "place", "sums", "at", "of", "offset", "upto", "units")


def _mixture(sized: DataFrame, weights: tuple[int, ...], share: float, most: float, seed: int) -> DataFrame:
    """``sized`` (key, source, size and more narrow columns), which is saved, with source_size, target, copies and taken."""
    goals = saved(targets(sized.select("source", "size"), weights, share, most).withColumnRenamed("source", "_source"), "mix-targets")
    expected = F.when(F.col("source_size") > 0, F.least(F.lit(int(most * UNIT)), F.floor(F.col("target") / F.col("source_size") * UNIT + 0.5))).otherwise(0).cast("long")
    rows = sized.join(broadcast_if_small(goals), F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("expected", expected)
    copied = systematic_copies(rows, "expected", "source", [F.asc("size"), F.asc_nulls_last("key")], seed)
    return copied.withColumn("taken", F.col("copies") * F.col("size"))


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
            share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken.

    Size is the number of words between ASCII white space (null text: none). All documents of a
    source expect target / source_size copies. They are taken in order of size, so that the words
    taken stay within about one document of the target; repeated rows are sampled one by one.
    Sources without a word expect no copy. An empty table gives an empty result.
    """
    sized = saved(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(whole(text)).alias("size")), "mix-sizes")
    return _mixture(sized, weights, share, most, seed).select(F.col("key").alias(key), "source", "size", "source_size", "target", "copies", "taken")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
          share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The documents of the mix, each repeated as often as it is taken; the columns of ``docs``.

    The documents are written once with a row number. Only that number, key, source and size are
    sorted and sampled; the copies of a row meet its text again in one join. Nulls, repeated rows
    and an empty table are handled as in ``mixture``.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    held = saved(docs.toDF(*names.values()).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    sized = saved(held.select(F.col(names[key]).alias("key"), F.col(names[source]).alias("source"), word_count(whole(names[text])).alias("size"), "row"), "mix-sizes")
    chosen = _mixture(sized, weights, share, most, seed).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return held.join(chosen, "row").select(*[F.col(n).alias(c) for c, n in names.items()])
