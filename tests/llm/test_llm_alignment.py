import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import alignment
from tabloom.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
TEXTS = ["", None, "hello world", " leading  and   inner \t\n spaces ", "\n", " ", "a", "<|endoftext|> </s> <s> <0x41> <unk>", "naïve Über 你好世界 \U0001f600\U0001f469‍\U0001f469 é ﬁ", "has ▁ mark", "▁",
         "don't it's we'll", "x" * 900, "1234567890 12,5%", "\x00 nul \x1c sep", "tabs\tand\nlines\r\n end", "日本語" * 150, "nbsp\xa0here 　wide   sep", "word " * 200, "hello world"]


def byte_table():
    """Characters of byte-level vocabularies: bytes that are not printable have the next free ones from 256 on."""
    out, spare = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[chr(b)] = b
        else:
            out[chr(spare)], spare = b, spare + 1
    return out


def brute(texts):
    """Whole texts through both tokenizers, and every pair of tokens compared by its byte range."""
    first, second, table = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_table()
    first.encode_special_tokens = True
    rows, per = [], []
    for text in texts:
        spans_a, spans_b = [], []
        if text:
            at = 0
            for token, i in zip((coded := first.encode(" " + text, add_special_tokens=False)).tokens, coded.ids):
                raw = bytes(table[c] for c in token)
                spans_a.append((at, at := at + len(raw), i, raw))
            at = 0
            for i in second.encode(text):
                piece = second.id_to_piece(i)
                raw = bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()
                spans_b.append((at, at := at + len(raw), i, raw))
            want = (" " + text).encode()
            if b"".join(s[3] for s in spans_a) != want or b"".join(s[3] for s in spans_b) != want:
                spans_a, spans_b = [], []
        ends, groups = sorted({s[1] for s in spans_a} & {s[1] for s in spans_b}), []
        for low, high in zip([0, *ends], ends):
            groups.append(",".join(str(s[2]) for s in spans_a if low < s[1] <= high) + "|" + ",".join(str(s[2]) for s in spans_b if low < s[1] <= high))
        links = Counter((s[2], t[2]) for s in spans_a for t in spans_b if s[0] < t[1] and t[0] < s[1])
        rows.append((len(spans_a), len(spans_b), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
        per.append(links)
    docs, top = Counter(p for links in per for p in links), defaultdict(int)
    for (a, _b), n in docs.items():
        top[a] = max(top[a], n)
    return [(*r[:4], sum(n for p, n in links.items() if docs[p] == top[p[0]]), sum(n * docs[p] for p, n in links.items()), r[4]) for r, links in zip(rows, per)]


def run(df, **more):
    rows = alignment.alignments(df, A, B, digest=True, **more).collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture(scope="module")
def compared(table):
    rows = [*enumerate(TEXTS)] + [(100 + r["doc_id"], r["text"]) for r in table("documents").where("n_chars < 2500").orderBy("doc_id").limit(40).collect()]
    return rows, sorted(((k, *r) for (k, _), r in zip(rows, brute([t for _, t in rows]))), key=str)


@pytest.mark.parametrize("head", [alignment.HEAD_PAIRS, 10, 0])
def test_equals_whole_texts(spark, compared, head):
    rows, want = compared
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), head_pairs=head) == want


def test_cuts_and_overlaps():
    assert alignment.cuts([1, 2, 3], [3, 1, 2]) == ([3, 6], [2, 3], [1, 3])
    assert alignment.overlaps([2, 2, 1], [1, 3, 1]) == [(0, 0), (0, 1), (1, 1), (2, 2)]
    assert alignment.cuts([], []) == ([], [], []) and alignment.overlaps([], []) == []


def test_memory_of_chunks_changes_nothing(monkeypatch, table):
    texts = [r["text"] or "" for r in table("documents").collect()]
    work = alignment.Aligner(A, B)
    want = work.align(texts)
    monkeypatch.setattr(alignment, "MEMO_BYTES", 1 << 12)
    small = alignment.Aligner(A, B)
    assert [r for at in range(0, len(texts), 7) for r in small.align(texts[at:at + 7])] == want
    monkeypatch.setattr(work, "cuts", False)
    assert [None if r is None else r.groups for r in work.align(texts[:50])] == [None if r is None else r.groups for r in want[:50]]


def test_real_outputs(spark):
    row = alignment.aligned(spark.createDataFrame([(1, "hello hello")], "doc_id long, text string"), A, B).first()
    assert row["groups"].split(";")[0] == row["groups"].split(";")[1] and sum(p["times"] for p in row["links"]) == row["n_links"]
    wide = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, None)], "doc_id long, text string").withColumns({c: F.lit("q") for c in ("row", "a", "b", "links", "docs", "groups")})
    assert len(run(wide)) == 3 and run(wide.limit(0)) == []
