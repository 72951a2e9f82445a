"""Packing by powers of two: every document is split by the binary digits of its length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import in_batches, saved, whole
from tabloom.llm.packing import END_ID, coder
from tabloom.session import broadcast_if_small

TOKENS = 2048
#: Tokens of a training batch, which holds sequences of one length only.
BATCH_TOKENS = 1 << 16
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int, place long, part int"


def binary_lengths(tokens: int, limit: int) -> list[int]:
    """Lengths of the pieces: as many of ``limit`` as fit, then one for each binary digit of the rest, longest first."""
    rest = tokens % limit
    return [limit] * (tokens // limit) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = TOKENS, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """The pieces of every document with their bucket (log2 of the length) and their place in it, counted within the task."""
    if limit & (limit - 1) or limit < 1:
        raise ValueError("the limit must be a power of two")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, filled = coder(tokenizer).encode, TaskContext.get().partitionId(), np.zeros(limit.bit_length(), dtype=np.int64)
        for batch in batches:
            keys, coded, rows, parts = batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), [], []
            for k, data in zip(keys, coded):
                data += end
                n, at = len(data) // 4, 0
                for length in binary_lengths(n, limit):
                    piece, bucket = data[4 * at:4 * (at + length)], length.bit_length() - 1
                    rows.append((k, at, length, zlib.crc32(piece), n, bucket, filled[bucket], part))
                    parts.append(piece)
                    filled[bucket] += 1
                    at += length
            if rows:
                columns = [pa.array(c, type=t) for c, t in zip(zip(*rows), [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.int32()])]
                names = [f.split()[0] for f in SCHEMA.split(", ")]
                if ids:
                    offsets = np.r_[0, np.cumsum(columns[2].to_numpy())].astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_batches(docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text")), run, SCHEMA + ", ids array<int>" * ids)


def packed(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = TOKENS, ids: bool = True, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, batch_id (and ids).

    A piece is a sequence of its own and as long as a power of two, so nothing is padded and no
    sequence crosses documents. Sequences of a bucket are numbered from 0 without gaps: a task
    counts its own, and the counts of the tasks before it are added from a table of one row per
    task and bucket. ``sequence_id`` is the bucket times 2^48 plus that number. ``batch_id``
    cuts a bucket into batches of ``batch_tokens`` tokens, all of one length.

    Null counts as the empty text, which is its end id alone. Repeated rows are packed one by one,
    other columns are not looked at, an empty table gives an empty result.
    """
    cut = saved(pieces(docs, tokenizer, key, text, limit, ids=ids), "binary-pieces")
    per = cut.groupBy("part", "bucket").agg(F.count("*").alias("n"))
    prior = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("part", "bucket", F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("before"))
    numbered = cut.join(broadcast_if_small(before), ["part", "bucket"]).withColumn("number", F.col("before") + F.col("place"))
    name = F.shiftleft(F.col("bucket").cast("long"), 48)
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("length")))
    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (name + F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                           "bucket", (name + F.floor(F.col("number") / per_batch)).alias("batch_id"), *["ids"] * ids)
