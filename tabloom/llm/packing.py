"""Best-fit packing of token pieces into sequences under several capacities."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import in_batches, saved, whole

TOKENS = 4096
END_ID = 1
#: Pieces that are packed together; a group leaves about one sequence part filled.
GROUP_PIECES = 16_384
#: Bytes of ids after which a worker sorts out what it keeps, and the length of the longest word that is kept then.
MEMO_BYTES, MEMO_WORD = 32 << 20, 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds at most: tokens, documents, and attention cost (sum of squared lengths)."""
    tokens: int = TOKENS
    documents: int = TOKENS
    attention: int = TOKENS * TOKENS
    #: Weights of the three residuals (each as a share of its capacity) in the norm.
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


# The tokenizer's own cut of a text into words, for ASCII and for Latin letters whose normal form and lower case are single letters.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
WORDS = rf"'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])|[{LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+"
PLAIN = re.compile(rf"[{LETTERS}!-@\[-`{{-~ \t\n\r]*")
PLAIN_WORDS = re.compile(WORDS)
#: The same in any text: a chunk between spaces that holds another character, or a "<" (special tokens), is one word.
MIXED_WORDS = re.compile(rf"(?<![^ \t\n\r])[{LETTERS}!-;=-@\[-`{{-~]*[^{LETTERS}!-;=-@\[-`{{-~ \t\n\r][^ \t\n\r]*|{WORDS}")


@cache
def byte_marks() -> list[str]:
    """The character that byte-level vocabularies use for each byte: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordEncoder:
    """Token ids of a text as little-endian 32-bit words.

    The tokenizer merges inside words only, and it never joins characters across a space, tab or
    line end. So the ids of a text are those of its words in a row. Words met before are not
    encoded again; what is kept is dropped once it was not used while MEMO_BYTES of others came.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words: plain ones by the tokenizer's model, chunks with other characters by the tokenizer."""
        out, other, tokenize, marks = {}, [], self.tokenizer.model.tokenize, byte_marks().__getitem__
        for word in words:
            if PLAIN_WORDS.fullmatch(word):
                small = word.lower()
                ids = [t.id for t in tokenize(small if small.isascii() else "".join(map(marks, small.encode())))]
                out[word] = pack_ids(f"<{len(ids)}I", *ids)
            else:
                other.append(word)
        for word, coded in zip(other, self.tokenizer.encode_batch(other, add_special_tokens=False)):
            out[word] = np.array(coded.ids, dtype="<u4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [(PLAIN_WORDS if "<|" not in t and PLAIN.fullmatch(t) else MIXED_WORDS).findall(t) for t in texts]
        missing = set().union(*cut) - self.known.keys()
        found = {w: self.older[w] for w in missing & self.older.keys()}
        found |= self._learn([*(missing - found.keys())])
        self.held += sum(200 + len(d) for d in found.values())
        self.known |= found
        out = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        if self.held > MEMO_BYTES:
            self.known, self.older, self.held = {}, {w: d for w, d in self.known.items() if len(w) <= MEMO_WORD}, 0
        return out


@lru_cache(maxsize=4)
def coder(path: str) -> WordEncoder:
    """One encoder per worker, so that its tasks share what is known."""
    return WordEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = TOKENS, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each text, ended by ``end_id`` and cut at ``limit``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(tokenizer).encode
        for batch in batches:
            keys, texts, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for k, ids in zip(keys, encode(texts)):
                ids += end
                for number, first in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[first:first + 4 * limit]
                    rows.append((k, number, first // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return in_batches(docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text")), run, PIECES)


def best_fit(lengths: np.ndarray, room: Capacities) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece: longest first, into the feasible bin with the smallest weighted residual norm.

    A bin is feasible if tokens, documents and attention cost all fit; if none is, a bin is opened.
    """
    order = np.argsort(-lengths, kind="stable")
    caps = np.array([room.tokens, room.documents, room.attention], dtype=np.float64)
    weights = np.array(room.weights) / caps ** 2
    needs = np.stack([lengths, np.ones_like(lengths), lengths * lengths]).astype(np.float64)
    if len(lengths) and (needs > caps[:, None]).any():
        raise ValueError("a piece is larger than a sequence's capacity")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    left, names, opened, count, least = np.empty((3, 1024)), np.empty(1024, dtype=np.int64), 0, 0, lengths.min(initial=0)
    for item in order:
        need = needs[:, item]
        after = left[:, :opened] - need[:, None]
        fits = np.flatnonzero((after >= 0).all(axis=0)) if opened else ()
        if len(fits):
            near = after[:, fits]
            at = fits[np.argmin(weights @ (near * near))]
        else:
            if opened == left.shape[1]:
                left, names = np.concatenate([left, np.empty_like(left)], axis=1), np.concatenate([names, np.empty_like(names)])
            at, opened = opened, opened + 1
            left[:, at], names[at], count = caps, count, count + 1
        bins[item], offsets[item] = names[at], room.tokens - left[0, at]
        left[:, at] -= need
        if left[0, at] < least or left[1, at] < 1:  # nothing fits any more: the last open bin takes its place
            opened -= 1
            left[:, at], names[at] = left[:, opened], names[opened]
    return bins, offsets


def _pack(room: Capacities) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            group = pa.Table.from_batches(rows).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]).combine_chunks()
            bins, offsets = best_fit(group["length"].to_numpy().astype(np.int64), room)
            out = group.append_column("sequence_id", pa.array(bins + (TaskContext.get().partitionId() << 32))).append_column("offset", pa.array(offsets))
            yield from out.to_batches()

    return run


def pack(cut: DataFrame, room: Capacities = Capacities(), group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` (gapless from 0).

    Pieces are dealt evenly into groups of about ``group_pieces``, whatever their keys, and each
    group is packed by itself: memory and time of a task do not grow with the data.
    """
    cut = saved(cut, "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    return in_batches(cut.repartition(groups), _pack(room), PACKED)


def packed(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", room: Capacities = Capacities()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null counts as the empty text, which is its end id alone. A document of more than
    ``room.tokens`` ids is cut into pieces of that length. Repeated rows are packed one by one;
    other columns are not looked at; an empty table gives an empty result.
    """
    return pack(pieces(docs, tokenizer, key, text, room.tokens), room)
