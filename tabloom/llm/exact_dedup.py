"""Exact deduplication by Grace hashing: partition until a bucket fits, then compare whole texts."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import BATCH_ROWS, in_batches, saved, whole
from tabloom.session import broadcast_if_small

#: A bucket is partitioned again while it holds more bytes of text than this and more than one hash.
BUCKET_BYTES = 32 << 20
#: Hash bits that one more level of partitioning uses.
LEVEL_BITS = 4
NO_ID = (1 << 63) - 1

PARTIAL = "pid long, h long, size long, first long, n long, ids array<long>, sha string, norm string"
MERGED = "pid long, keep_pid long, keep long, total long"


class ContentTable:
    """Open-addressing table of whole texts.

    Linear probing from the low bits of a 64-bit hash (the buckets use the high bits); two texts
    are the same entry only if their complete content is equal.
    """

    def __init__(self) -> None:
        self.slots, self.mask = [-1] * 1024, 1023
        self.hashes: list[int] = []
        self.texts: list[str] = []
        self.bytes = 0

    def entry(self, h: int, text: str) -> int:
        """Number of the text's entry, a new one if the table lacks it."""
        slots, hashes, texts = self.slots, self.hashes, self.texts
        at = h & self.mask
        while (found := slots[at]) >= 0:
            if hashes[found] == h and texts[found] == text:
                return found
            at = (at + 1) & self.mask
        slots[at] = len(texts)
        hashes.append(h)
        texts.append(text)
        self.bytes += len(text)
        if 2 * len(texts) > self.mask:
            self._grow()
        return len(texts) - 1

    def _grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.slots = [-1] * (self.mask + 1)
        for number, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = number


def collapse_space(column: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed and return as one space."""
    for mark in "\t\n\x0b\x0c\r":
        column = F.replace(column, F.lit(mark), F.lit(" "))
    return F.when(F.contains(column, F.lit("  ")), F.regexp_replace(column, " {2,}", " ")).otherwise(column)


def _id(value: int | None) -> int:
    return NO_ID if value is None else value


def _partials(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Copies within one input partition meet here, so that a popular text is one row per task."""
    schema = pa.schema([("pid", pa.int64()), ("h", pa.int64()), ("size", pa.int64()), ("first", pa.int64()), ("n", pa.int64()),
                        ("ids", pa.list_(pa.int64())), ("sha", pa.string()), ("norm", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for ids in members:
                low = min(range(len(ids)), key=lambda i: _id(ids[i]))
                ids[0], ids[low] = ids[low], ids[0]
            count = len(held.texts)
            for at in range(0, count, BATCH_ROWS):
                part = slice(at, min(at + BATCH_ROWS, count))
                texts = held.texts[part]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip([
                    [base + made + i for i in range(len(texts))], held.hashes[part], [len(t) for t in texts],
                    [_id(ids[0]) for ids in members[part]], [len(ids) for ids in members[part]], members[part], shas[part], texts], schema)], schema=schema)
                made += len(texts)

        held, members, shas = ContentTable(), [], []
        for batch in batches:
            for key, h, sha, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                at = held.entry(h, text)
                if at == len(members):
                    members.append([key])
                    shas.append(sha)
                else:
                    members[at].append(key)
            if held.bytes > limit:
                yield from flush()
                held, members, shas = ContentTable(), [], []
        yield from flush()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come bucket by bucket; one bucket's table is held at a time."""
    schema = pa.schema([(n, pa.int64()) for n in ("pid", "keep_pid", "keep", "total")])
    held, groups, bucket = ContentTable(), [], None

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [(pid, keep_pid, keep, total) for pids, (keep, keep_pid), total in groups for pid in pids]
        for at in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows[at:at + 50_000])], schema=schema)

    for batch in batches:
        for at, pid, h, first, n, text in zip(*(c.to_pylist() for c in batch.columns)):
            if at != bucket:
                yield from flush()
                held, groups, bucket = ContentTable(), [], at
            entry = held.entry(h, text)
            if entry == len(groups):
                groups.append([[pid], (first, pid), n])
            else:
                group = groups[entry]
                group[0].append(pid)
                group[1] = min(group[1], (first, pid))
                group[2] += n
    yield from flush()


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")


def grace_buckets(parts: DataFrame, bucket_bytes: int) -> tuple[Column, DataFrame, int]:
    """Bucket of each row, the rows with it, and the number of first-level buckets.

    The sizes of all buckets are counted first, so a text moves once, into its last bucket. A
    bucket beyond the bound is partitioned by further hash bits until it fits or holds one hash.
    """
    total = parts.agg(F.sum("size")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, 2 * total / bucket_bytes))))
    first, out = depth, parts.withColumn("bucket", _prefix(depth)).withColumn("depth", F.lit(depth))
    while depth < 64:
        sizes = out.where(F.col("depth") == depth).groupBy("bucket").agg(
            F.sum("size").alias("bytes"), F.min("h").alias("low"), F.max("h").alias("high"))
        large = sizes.where((F.col("bytes") > bucket_bytes) & (F.col("low") < F.col("high"))).select("bucket", F.lit(depth).alias("depth"), F.lit(True).alias("split"))
        if large.isEmpty():
            break
        depth = min(64, depth + LEVEL_BITS)
        out = out.join(broadcast_if_small(large), ["bucket", "depth"], "left").withColumn("bucket", F.when(F.col("split"), _prefix(depth)).otherwise(F.col("bucket"))).withColumn(
            "depth", F.when(F.col("split"), depth).otherwise(F.col("depth"))).drop("split")
    return F.xxhash64("bucket", "depth"), out, 1 << first


def _first_rows(batches: Iterator[tuple[int | None, pa.RecordBatch]], limit: int | None) -> Iterator[pa.Table]:
    """The row with the smallest id (then text) of each text: per bucket, or each time the table holds ``limit``.

    Batches have the columns id, h, norm and body first. Rows that may stay are copied out of
    their batch, so that a batch is not held for one row.
    """
    held, best, rows, bucket = ContentTable(), [], [], None
    for at, batch in batches:
        if rows and (at != bucket or (limit is not None and held.bytes > limit)):
            yield pa.Table.from_batches(rows).combine_chunks()
            held, best, rows = ContentTable(), [], []
        bucket, fresh = at, {}
        for row, (key, h, norm, body) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)))):
            entry = held.entry(h, norm)
            if entry == len(best):
                best.append((_id(key), body or ""))
                rows.append(batch)
                fresh[entry] = row
            elif (_id(key), body or "") < best[entry]:
                best[entry] = (_id(key), body or "")
                fresh[entry] = row
        stay = batch.take(pa.array(list(fresh.values()), pa.int64()))
        for place, entry in enumerate(fresh):
            rows[entry] = stay.slice(place, 1)
    if rows:
        yield pa.Table.from_batches(rows).combine_chunks()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches cut where the first column, the bucket, changes; without that column."""
    for batch in batches:
        values, start = batch.column(0).to_pylist(), 0
        for end in range(1, len(values) + 1):
            if end == len(values) or values[end] != values[start]:
                part = batch.slice(start, end - start)
                yield values[start], pa.RecordBatch.from_arrays(part.columns[1:], names=part.schema.names[1:])
                start = end


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows that stay, with all columns of ``docs``: of equal texts the one with the smallest key.

    Equality, order and buckets as in ``exact_groups`` (of rows with equal key and text the
    smallest original text stays). Documents travel whole, so the text moves once and no join
    back to ``docs`` is needed.
    """
    names = [f"d{i}" for i in range(len(docs.columns))]
    body, number = names[docs.columns.index(text)], names[docs.columns.index(key)]
    rows = docs.toDF(*names).select(F.col(number).cast("long").alias("id"), collapse_space(whole(body)).alias("norm"), F.col(body).alias("body"), *names)
    rows = rows.select("id", F.xxhash64("norm").alias("h"), "norm", "body", *names)
    schema = rows.select("id", "h", F.lit(0).cast("long").alias("size"), *names).schema

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _first_rows(((None, b) for b in batches), bucket_bytes):
            sizes = pa.array([len(t) for t in found["norm"].to_pylist()], pa.int64())
            yield from pa.table([found["id"], found["h"], sizes, *(found[c] for c in names)], names=["id", "h", "size", *names]).to_batches(BATCH_ROWS)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _first_rows(_runs(batches), None):
            yield from found.select(names).to_batches(BATCH_ROWS)

    bucket, dealt, count = grace_buckets(saved(in_batches(rows, first, schema), "dedup-rows"), bucket_bytes)
    n = max(count, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_rows = dealt.select(bucket.alias("at"), "id", "h", *names).repartition(n, "at").sortWithinPartitions("at")
    met = sorted_rows.select("at", "id", "h", collapse_space(whole(body)).alias("norm"), F.col(body).alias("body"), *names)
    return in_batches(met, last, rows.select(*names).schema).toDF(*docs.columns)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: ``key``, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space; null
    counts as empty. The row with the smallest key stays (rows without a key come last; of rows
    with the same key and text one stays). Other columns of ``docs`` are not looked at, an empty
    table gives an empty result.

    Copies inside one input partition are merged before anything is shuffled, so a text that a
    third of all rows share costs a row per task. The texts are then dealt into buckets by the
    leading bits of their hash, deeper while a bucket is too large, and each bucket is resolved in
    an open-addressing table that compares complete texts.
    """
    norm = docs.select(F.col(key).cast("long").alias("id"), collapse_space(whole(text)).alias("norm"))
    rows = norm.select("id", F.xxhash64("norm").alias("h"), F.sha2("norm", 256).alias("sha"), "norm")
    parts = saved(in_batches(rows, _partials(bucket_bytes), PARTIAL), "dedup-partials")
    bucket, dealt, count = grace_buckets(parts, bucket_bytes)
    n = max(count, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = dealt.select(bucket.alias("at"), "pid", "h", "first", "n", "norm").repartition(n, "at").sortWithinPartitions("at")
    merged = in_batches(met, _merge, MERGED)
    return (parts.select("pid", "ids", "sha").join(merged, "pid")
            .select(F.posexplode("ids").alias("place", key), "pid", "keep_pid", "keep", "total", "sha")
            .select(key, F.when(F.col("keep") != NO_ID, F.col("keep")).alias("keep_id"), F.col("total").alias("group_size"),
                    ((F.col("pid") == F.col("keep_pid")) & (F.col("place") == 0)).alias("kept"), F.col("sha").alias("text_sha256")))
