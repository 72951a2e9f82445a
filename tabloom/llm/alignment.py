"""Alignment of two tokenizers' tokens by the byte offsets where both end."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import in_batches, saved, whole
from tabloom.llm.packing import byte_marks

#: Pairs whose counts are broadcast: the most frequent ones, at most this many. All others are joined by shuffle.
HEAD_PAIRS = 400_000
#: Bytes of alignments after which a worker sorts out what it keeps, and the length of the longest chunk that is kept then.
MEMO_BYTES, MEMO_CHUNK = 64 << 20, 64
#: Chunks that are tokenised as one text.
BLOCK = 4096
#: A single space between two characters that are no white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Any other space: one beside white space.
WIDE = re.compile(r" \s|[^\S ] ")
LINKS = "array<struct<a:int,b:int,times:int>>"


class Aligned(NamedTuple):
    """The alignment of a text: its groups as text, its links (A id in the high, B id in the low half), and its numbers of tokens."""
    groups: str
    links: bytes
    n_a: int
    n_b: int


def cuts(a_sizes: list[int], b_sizes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Offsets where tokens of both lists over the same bytes end, and how many tokens of each list end up to there.

    The ends of each list, as running sums, are keys of a dictionary that tells the token's
    number; the keys in common, sorted, cut both lists into slices.
    """
    a_at, b_at = dict(zip(accumulate(a_sizes), count(1))), dict(zip(accumulate(b_sizes), count(1)))
    common = sorted(a_at.keys() & b_at.keys())
    return common, [*map(a_at.__getitem__, common)], [*map(b_at.__getitem__, common)]


def overlaps(a_sizes: list[int], b_sizes: list[int]) -> list[tuple[int, int]]:
    """Numbers of the tokens of two lists over the same bytes whose byte ranges overlap."""
    out, i, j, ahead = [], 0, 0, 0  # ahead: how far the end of a's token i lies before (-) or behind (+) the end of b's token j
    if a_sizes and b_sizes:
        ahead = a_sizes[0] - b_sizes[0]
        out.append((0, 0))
    while i + 1 < len(a_sizes) or j + 1 < len(b_sizes):
        step_a, step_b = ahead <= 0, ahead >= 0
        if step_a:
            i += 1
            ahead += a_sizes[i]
        if step_b:
            j += 1
            ahead -= b_sizes[j]
        out.append((i, j))
    return out


class Aligner:
    """Aligns texts under a byte-level tokenizer (A, of a space and the text) and a piece model (B, which adds the space).

    Neither joins characters across a single space that stands between two other characters: A
    cuts there before it merges, and no piece of B holds a space behind another character (checked).
    Both lists end there, so a text's alignment is that of its chunks in a row. Chunks met before
    are not aligned again; what is kept is dropped once it was not used while MEMO_BYTES of others came.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first, self.second = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.first.encode_special_tokens = True
        shown = {mark: byte for byte, mark in enumerate(byte_marks())}
        self.a_bytes: dict[int, bytes] = {i: bytes(map(shown.get, t)) if set(t) <= shown.keys() else t.encode() for t, i in self.first.get_vocab(with_added_tokens=True).items()}
        model, self.b_bytes, self.cuts = self.second, [], True
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
            self.cuts &= "▁" not in piece.lstrip("▁")
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        self.held = 0

    def _aligned(self, chunks: list[str]) -> dict[str, tuple | None]:
        """Alignments of chunks, which are put behind each other with spaces, tokenised and sliced as one text."""
        text = " ".join(chunks)
        a, b = self.first.encode(" " + text, add_special_tokens=False).ids, self.second.encode(text)
        a_parts, b_parts = [*map(self.a_bytes.get, a)], [*map(self.b_bytes.__getitem__, b)]
        if not b"".join(a_parts) == b"".join(b_parts) == b" " + text.encode():
            return {chunks[0]: None} if len(chunks) == 1 else {c: r for one in chunks for c, r in self._aligned([one]).items()}
        a_sizes, b_sizes = [*map(len, a_parts)], [*map(len, b_parts)]
        ends, a_cut, b_cut = cuts(a_sizes, b_sizes)
        a_from, b_from = np.array([0, *a_cut]), np.array([0, *b_cut])
        a_ids, b_ids = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        # Slices of one token each are most of all: their names and links are made at once, the others' one by one.
        names = [f"{x}|{y}" for x, y in zip(a_ids[a_from[:-1]].tolist(), b_ids[b_from[:-1]].tolist())]
        links, each = a_ids[a_from[:-1]] << 32 | b_ids[b_from[:-1]], np.ones(len(ends), dtype=np.int64)
        more, at = [], np.flatnonzero((np.diff(a_from) > 1) | (np.diff(b_from) > 1))
        for g, i, i_end, j, j_end in zip(at.tolist(), *[c.tolist() for c in (a_from[at], a_from[at + 1], b_from[at], b_from[at + 1])]):
            names[g] = f"{','.join(map(str, a[i:i_end]))}|{','.join(map(str, b[j:j_end]))}"
            found = [a[i + p] << 32 | b[j + q] for p, q in overlaps(a_sizes[i:i_end], b_sizes[j:j_end])]
            each[g] = len(found)
            more += found
        firsts = np.r_[0, np.cumsum(each)]
        spread, taken = np.repeat(links, each), np.zeros(len(ends), dtype=bool)
        taken[at] = True
        spread[np.repeat(taken, each)] = np.array(more, dtype=np.int64)
        data, order = spread.tobytes(), dict(zip(ends, count(1)))
        upto = [0, *map(order.__getitem__, accumulate(1 + len(c.encode()) for c in chunks))]
        places = [x[upto].tolist() for x in (8 * firsts, a_from, b_from)]
        return {c: (";".join(names[g:h]), data[x:y], i_end - i, j_end - j)
                for c, g, h, x, y, i, i_end, j, j_end in zip(chunks, upto, upto[1:], *[v for p in places for v in (p, p[1:])])}

    def chunks(self, text: str) -> list[str]:
        if not self.cuts or not text:
            return [text] if text else []
        if text[0].isspace() or text[-1].isspace() or WIDE.search(text):
            return CUT.split(text)
        return text.split(" ")

    def align(self, texts: list[str]) -> list[Aligned | None]:
        """Of every text its alignment; none if it is empty or the tokens' bytes are not those of a space and the text."""
        cut = [*map(self.chunks, texts)]
        missing = set().union(*cut) - self.known.keys()
        found = {c: self.older[c] for c in missing & self.older.keys()}
        fresh = [*(missing - found.keys())]
        alone = [c for c in fresh if not c or c[0].isspace() or c[-1].isspace() or len(c) > MEMO_CHUNK]
        fresh = [*(set(fresh) - set(alone))]
        for block in [[c] for c in alone] + [fresh[at:at + BLOCK] for at in range(0, len(fresh), BLOCK)]:
            found |= self._aligned(block)
        self.held += sum([400 + (len(r[0]) + len(r[1]) if r else 0) for r in found.values()])
        self.known |= found
        out = []
        for chunks in cut:
            parts = [*map(self.known.__getitem__, chunks)]
            if parts and None not in parts:
                groups, links, n_a, n_b = zip(*parts)
                out.append(Aligned(";".join(groups), b"".join(links), sum(n_a), sum(n_b)))
            else:
                out.append(None)
        if self.held > MEMO_BYTES:
            self.known, self.older, self.held = {}, {c: r for c, r in self.known.items() if len(c) <= MEMO_CHUNK}, 0
        return out


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker, so that its tasks share what is known."""
    return Aligner(a_path, b_path)


def aligned(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups, links.

    ``groups`` is the text ``a1,a2|b1;a3|b2`` (with ``digest`` its SHA-256 in hex; without tokens
    always the empty text), ``links`` the distinct id pairs linked in the document with the number
    of their occurrences. Nothing is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(a_path, b_path)
        for batch in batches:
            rows, parts, times = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for got in work.align(batch.column(1).to_pylist()):
                if got is None:
                    rows.append((0, 0, 0, 0, "", 0))
                    continue
                pairs, n = np.unique(np.frombuffer(got.links, dtype=np.int64), return_counts=True)
                parts.append(pairs)
                times.append(n)
                told = hashlib.sha256(got.groups.encode()).hexdigest() if digest else got.groups
                rows.append((got.n_a, got.n_b, 1 + got.groups.count(";"), len(got.links) // 8, told, len(pairs)))
            columns, pairs = [*zip(*rows)] if rows else [()] * 6, np.concatenate(parts)
            pairs = pa.StructArray.from_arrays([pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)),
                                                pa.array(np.concatenate(times).astype(np.int32))], names=["a", "b", "times"])
            links = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(columns[5])].astype(np.int32)), pairs)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string()), links],
                                             names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text"))
    return in_batches(rows, run, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links {LINKS}")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, docs, best): in how many documents each id pair is linked, and whether no pair of the same A id has more.

    A's ids are fewer than 2^16 and ``a`` is the only key of the second step, so its table may be broadcast.
    """
    counts = saved(rows.select(F.explode("links").alias("l")).groupBy("l.a", "l.b").agg(F.count("*").alias("docs")), "pair-counts")
    top = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(top), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def scored(rows: DataFrame, counts: DataFrame, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of ``rows`` (row, links): links whose pair is the best of its A id, and their counts summed.

    The pairs in most documents are looked up in a broadcast of at most ``head_pairs`` rows; the
    bound on their frequency comes from a histogram over powers of two. A pair beyond it is in
    few documents, so the shuffle that joins the others has no hot key.
    """
    size = F.floor(F.log2("docs")).cast("int")
    upto, least = 0, 0
    for power, n in sorted(counts.groupBy(size).count().collect(), reverse=True):
        upto += n
        if upto > head_pairs:
            least = 2 << power
            break
    links = rows.select("row", F.explode("links").alias("l")).select("row", "l.a", "l.b", "l.times")
    told = links.join(F.broadcast(counts.where(F.col("docs") >= least)), ["a", "b"], "left" if least else "inner")
    if least:
        rest = told.where("docs IS NULL").select("row", "a", "b", "times").join(counts.where(F.col("docs") < least).hint("shuffle_hash"), ["a", "b"])
        told = told.where("docs IS NOT NULL").select("row", "times", "docs", "best").unionByName(rest.select("row", "times", "docs", "best"))
    return told.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))


def alignments(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = False, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """One row per document: ``key``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A document whose text is null, empty, or not what the tokens of both sides spell has no
    tokens: zeros and the empty text. Repeated rows stay and count one by one; other columns are
    not looked at; an empty table gives an empty result.
    """
    rows = saved(aligned(docs, a_path, b_path, key, text, digest).withColumn("row", F.monotonically_increasing_id()), "alignments")
    counts = saved(pair_counts(rows), "pair-best")
    totals = scored(rows, counts, head_pairs)
    zero = F.lit(0).cast("long")
    return rows.drop("links").join(totals, "row", "left").select(
        F.col("doc_id").alias(key), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups")
