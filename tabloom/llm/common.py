"""Shared helpers: tables, saved intermediates, word shingles and their hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import scratch_path

#: Bytes and rows of an Arrow batch that goes to Python; a batch exists twice on either side.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 10_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: no lineage, so a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with batches of about BATCH_BYTES at most, as rows hold whole texts (one longer text is a batch of its own).

    Spark has the two bounds as settings of the session only; neither changes any result.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of narrow rows joined to about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def whole(text: str) -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """Runs of ``size`` words joined by a space, repeats included; fewer words give one run, none none."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    return [joined[a:b - 1] for a, b in zip(starts, ends[size - 1:])]


def shingle_hashes(text: str, size: int, seed: int = 42) -> np.ndarray:
    """Unsigned XXH64 of every shingle of the text's words; A-Z lowered, words end at ASCII white space."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, seed) for s in shingles(text.encode().lower().split(), size)], dtype=np.uint64)


def bit_counts(hashes: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """How many hashes have each of the 64 bits, lowest bit first."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), block):
        part = np.ascontiguousarray(hashes[at:at + block])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches of rows sorted by ``key`` so that no key is cut; each yield holds whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[len(keys) - 1]
        if keys[0] == last and held and held[-1].column(key)[held[-1].num_rows - 1] == last:
            held.append(batch)
            continue
        values = keys.to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(values, values[-1], side="left"))
        if cut or held:
            if held and held[-1].column(key)[held[-1].num_rows - 1] != keys[0]:
                yield pa.Table.from_batches(held)
                held = []
            if cut:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)
