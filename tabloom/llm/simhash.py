"""SimHash near-duplicates: fingerprints, bit-sliced comparison inside bands, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import bit_counts, gathered, in_batches, saved, shingle_hashes, sorted_groups, whole
from tabloom.llm.components import connected_components
from tabloom.session import broadcast_if_small

SHINGLE_WORDS = 3
MAX_BITS = 3
#: A group with more rows is banded again, and one that is still larger is compared block by block.
GROUP_ROWS = 2048
#: Groups up to this size are compared as lists of pairs, larger ones as a matrix of queries and lanes.
PAIR_ROWS = 8
PLANES_PER_LOOK = 8


def fingerprint(text: str, size: int) -> int:
    """64 bits; a bit is set if over half the shingle hashes have it. No words: zero. Signed."""
    hashes = shingle_hashes(text, size)
    bits = (2 * bit_counts(hashes) > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, digest: bool = False) -> DataFrame:
    """(id, fp) of every document, with ``digest`` also the text's MD5 as ``h``; the text is read once and not shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, type=pa.int64()), *batch.columns[2:]], names=["id", "fp", "h"][:2 + digest])

    rows = docs.select(F.col(key).cast("long").alias("id"), whole(text).alias("text"), *[F.md5(whole(text)).alias("h")] * digest)
    return in_batches(rows, run, "id long, fp long" + ", h string" * digest)


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Vertical layout: row p holds bit p of all fingerprints, 64 lanes to a word."""
    padded = np.concatenate([fps.astype(np.uint64), np.zeros(-len(fps) % 64, dtype=np.uint64)])
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near_lanes(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray | None:
    """Bit per (query, lane): at most ``radius`` bits differ. None once every lane of the block is farther.

    All distances are counted at once by carry-save adders over the planes. The counters start so
    that exceeding the radius overflows, and the overflow sticks.
    """
    width = max(1, radius.bit_length())
    spare = (1 << width) - 1 - radius
    shape = (len(queries), planes.shape[1])
    counters = [np.full(shape, ~np.uint64(0) if spare >> i & 1 else np.uint64(0)) for i in range(width)]
    over = np.zeros(shape, dtype=np.uint64)
    masks = np.uint64(0) - (queries.astype(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1))
    for p in range(64):
        carry = planes[p][None, :] ^ masks[:, p][:, None]
        for i, counter in enumerate(counters):
            carried = counter & carry
            counters[i] = counter ^ carry
            carry = carried
        over |= carry
        if p % PLANES_PER_LOOK == PLANES_PER_LOOK - 1 and (over == ~np.uint64(0)).all():
            return None
    return ~over


def _lanes(words: np.ndarray, count: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")[:, :count].astype(bool)


def small_group_links(keys: np.ndarray, fps: np.ndarray, radius: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked places among rows of one key that are up to ``reach`` rows apart."""
    left, right = [], []
    for step in range(1, reach):
        at = np.flatnonzero(keys[:-step] == keys[step:])
        if not len(at):
            break
        for cut in range(0, len(at), 1 << 16):
            part = at[cut:cut + (1 << 16)]
            near = near_lanes(bit_planes(fps[part] ^ fps[part + step]), np.zeros(1, dtype=np.uint64), radius)
            if near is not None:
                hit = part[_lanes(near, len(part))[0]]
                left.append(hit)
                right.append(hit + step)
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def group_roots(fps: np.ndarray, radius: int, chunk: int = 256) -> np.ndarray:
    """Smallest place that each row reaches inside its group, by whole-group comparison."""
    planes, n = bit_planes(fps), len(fps)
    near = np.zeros((n, n), dtype=bool)
    for at in range(0, n, chunk):
        words = near_lanes(planes, fps[at:at + chunk], radius)
        if words is not None:
            near[at:at + chunk] = _lanes(words, n)
    linked = np.flatnonzero(near.sum(axis=1) > 1)
    roots = np.arange(n)
    near = near[np.ix_(linked, linked)]
    label = np.arange(len(linked), dtype=np.int32)
    while len(linked):
        low = np.where(near, label[None, :], np.int32(n)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    roots[linked] = linked[label] if len(linked) else roots[linked]
    return roots


def _link(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Forest of the links of each group: one edge a row at most from a matrix group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(gathered(batches), "at"):
            keys = rows["at"].to_numpy()
            ids, fps = rows["id"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[starts, len(keys)])
            small = np.repeat(sizes <= PAIR_ROWS, sizes)
            a, b = small_group_links(keys[small], fps[small], radius, PAIR_ROWS)
            edges = [(ids[small][a], ids[small][b])]
            for start, size in zip(starts[sizes > PAIR_ROWS], sizes[sizes > PAIR_ROWS]):
                roots = group_roots(fps[start:start + size], radius)
                own = ids[start:start + size]
                hung = np.flatnonzero(roots != np.arange(size))
                edges.append((own[hung], own[roots[hung]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*edges)], names=["a", "b"])

    return run


def bands(count: int, free: list[int]) -> list[list[int]]:
    """The bit positions ``free`` in ``count`` runs of nearly equal length."""
    return [part.tolist() for part in np.array_split(np.array(free), count)]


def _bits(positions: list[int]) -> Column:
    """Those bits of ``fp`` (a run of neighbours), others zero."""
    mask = sum(1 << p for p in positions)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def banded(fps: DataFrame, radius: int) -> DataFrame:
    """(at, id, fp): two fingerprints within the radius have some ``at`` in common.

    They agree on one of radius + 1 bands (a difference in each would be one too many). Groups
    beyond GROUP_ROWS are banded once more on their other bits by the same argument; what is
    still larger is cut into blocks, and every two blocks meet in a group of their own. No row
    and no link is left out at any size.
    """
    outer = bands(radius + 1, list(range(64)))
    first = fps.select("id", "fp", F.posexplode(F.array([_bits(b) for b in outer])).alias("band", "value")).withColumn("at", F.xxhash64("band", "value"))
    sizes = first.groupBy("at").count().where(F.col("count") > GROUP_ROWS)
    hot = saved(sizes.select("at"), "hot-bands")
    if hot.isEmpty():
        return first.select("at", "id", "fp")
    hot = broadcast_if_small(hot)
    again = [[_bits(b) for b in bands(radius + 1, [p for p in range(64) if p not in outer[o]])] for o in range(radius + 1)]
    second = (first.join(hot, "at", "left_semi")
              .select("at", "id", "fp", F.posexplode(F.element_at(F.array([F.array(a) for a in again]), F.col("band") + 1)).alias("inner", "part"))
              .select(F.xxhash64("at", "inner", "part").alias("at"), "id", "fp"))
    large = saved(second.groupBy("at").count().where(F.col("count") > GROUP_ROWS).select("at", F.ceil(F.col("count") / GROUP_ROWS).cast("int").alias("blocks")), "hot-bands")
    large = broadcast_if_small(large)
    blocks = (second.join(large, "at").withColumn("own", F.pmod(F.xxhash64("fp"), "blocks"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(F.xxhash64("at", F.least("own", "other"), F.greatest("own", "other")).alias("at"), "id", "fp"))
    return (first.join(hot, "at", "left_anti").select("at", "id", "fp")
            .unionByName(second.join(large, "at", "left_anti")).unionByName(blocks))


def _linked(nodes: DataFrame, radius: int) -> DataFrame:
    """(node, component) of the ``nodes`` (id, fp) that are linked to one with a smaller id."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return connected_components(in_batches(banded(nodes, radius).repartition(n, "at").sortWithinPartitions("at"), _link(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """One row per document: ``key``, fingerprint (16 hex digits), component_id.

    Texts are lower-cased in A-Z and cut at ASCII white space into words; null counts as empty,
    a text without words has fingerprint zero and is linked like any other. Documents link at
    ``radius`` or fewer differing bits; component_id is the smallest key reachable. Equal
    fingerprints are compared once, as one node. A document without a key belongs to the
    component of its fingerprint (null if no document with a key has it) and is no node itself.
    Repeated rows stay repeated. Other columns are not looked at.
    """
    prints = saved(fingerprints(docs, key, text, size), "fingerprints")
    nodes = saved(prints.groupBy("fp").agg(F.min("id").alias("id")).where("id IS NOT NULL"), "nodes")
    found = _linked(nodes, radius)
    reached = nodes.join(found, nodes["id"] == found["node"], "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return (prints.join(reached, "fp", "left")
            .select(F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest key (a missing key comes last).

    Components are those of the fingerprints themselves, so documents of one key and unlike texts
    are told apart, and a document without a key goes like any other. If several texts of a component
    have the smallest key, the one with the smallest MD5 stays, and one of its repeated rows. Null
    counts as the empty text; an empty table gives an empty result. Only keys and digests move to
    the documents, in one join.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*names.values())
    prints = saved(fingerprints(rows, names[key], names[text], size, digest=True).groupBy("fp", "id", "h").agg(F.count("*").alias("n")), "fingerprints")
    nodes = prints.select("fp").distinct().select(F.col("fp").alias("id"), "fp")
    found = _linked(nodes, radius)
    grouped = prints.join(found, prints["fp"] == found["node"], "left").select(F.coalesce("component", "fp").alias("component"), "id", "h", "n")
    first = F.min(F.struct(F.isnull("id").alias("none"), "id", "h", "n")).alias("first")
    stay = saved(grouped.groupBy("component").agg(first).select("first.id", "first.h", "first.n"), "stay")
    chosen = rows.join(stay, F.col(names[key]).cast("long").eqNullSafe(F.col("id")) & (F.md5(whole(names[text])) == F.col("h")))
    single = chosen.where("n = 1").select(*names.values())
    if not stay.where("n > 1").isEmpty():
        row = F.struct(*names.values())
        repeated = chosen.where("n > 1").groupBy("id", "h").agg(F.min_by(row, F.to_json(row)).alias("row"))
        single = single.unionByName(repeated.select("row.*"))
    return single.toDF(*names)
