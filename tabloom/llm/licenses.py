"""License scans: ordered signature rules behind a keyword prefilter, with containment suppression."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import in_batches, whole
from tabloom.llm.toxicity import words

# Phrases and labels of the base rules.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: License names: label, keyword that every text the pattern accepts holds, pattern of the name on words joined by spaces.
NAMES = (
    ("mit", "mit", r"mit"),
    ("apache-2.0", "apache", r"apache(?: software)? licen[cs]e(?: version)? 2(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[cs]e(?: version)? 1 1"),
    ("gpl-3.0", "public", r"(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version)? (?:v3|3)(?: 0)?"),
    ("gpl-2.0", "public", r"(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version)? (?:v2|2)(?: 0)?"),
    ("gpl-1.0", "public", r"(?:gnu )?general public licen[cs]e(?: version)? (?:v1|1)(?: 0)?"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: version)? (?:v3|3)(?: 0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: version)? 2 1"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[cs]e(?:(?: version)? (?:v3|3)(?: 0)?)?"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: version)?(?: v)? ?2(?: 0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: version)? 1 1"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: version)?(?: v)? ?2(?: 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: version)?(?: v)? ?1(?: 0)?"),
    ("cddl-1.0", "distribution", r"common development and distribution licen[cs]e(?:(?: version)? 1 0)?"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd)"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?:(?: version)? 1 0)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "public", r"do what the fuck you want to public licen[cs]e"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version)? 2(?: 0)?"),
    ("artistic-1.0", "artistic", r"artistic licen[cs]e"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", " by nc nd", r"(?:cc|creative commons) by nc nd(?: \d(?: \d)?)?"),
    ("cc-by-nc-sa", " by nc sa", r"(?:cc|creative commons) by nc sa(?: \d(?: \d)?)?"),
    ("cc-by-nc", " by nc", r"(?:cc|creative commons) by nc(?: \d(?: \d)?)?"),
    ("cc-by-nd", " by nd", r"(?:cc|creative commons) by nd(?: \d(?: \d)?)?"),
    ("cc-by-sa", " by sa", r"(?:cc|creative commons) by sa(?: \d(?: \d)?)?"),
    ("cc-by", " by", r"(?:cc|creative commons) by(?: \d(?: \d)?)?"),
    ("cc-by-nc", "commercial", r"creative commons attribution non ?commercial(?: \d \d)?(?: international)?"),
    ("cc-by-sa", "alike", r"creative commons attribution share ?alike(?: \d \d)?(?: international)?"),
    ("cc-by", "attribution", r"creative commons attribution(?: \d \d)?(?: international)?"),
    ("psf", "python", r"python software foundation licen[cs]e"),
    ("ofl-1.1", "font", r"sil open font licen[cs]e(?:(?: version)? 1 1)?"),
    ("odbl", "database", r"open (?:data commons )?database licen[cs]e"),
    ("gfdl", "documentation", r"gnu free documentation licen[cs]e(?:(?: version)? 1 [123])?"),
    ("eupl", "european", r"european union public licen[cs]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("upl-1.0", "universal", r"universal permissive licen[cs]e"),
    ("openssl", "openssl", r"openssl"),
    ("postgresql", "postgresql", r"postgresql"),
    ("vim", "vim", r"vim"),
    ("php", "php", r"php"),
    ("ruby", "ruby", r"ruby"),
    ("x11", "x11", r"x11"),
    ("ncsa", "illinois", r"university of illinois(?: ncsa)? open source"),
    ("afl-3.0", "academic", r"academic free licen[cs]e(?:(?: version)? 3 0)?"),
    ("osl-3.0", "open", r"open software licen[cs]e(?:(?: version)? 3 0)?"),
)
#: Ways to grant a license: strength, keyword, pattern around the name.
FORMS = (
    (1.0, "licen", r"(?:is |are )?licen[cs]ed under(?: the)?(?: terms of(?: the)?)? {name}(?: licen[cs]e)?"),
    (1.0, "released", r"released under(?: the)?(?: terms of(?: the)?)? {name}(?: licen[cs]e)?"),
    (1.0, "distributed", r"(?:re)?distributed under(?: the)?(?: terms of(?: the)?)? {name}(?: licen[cs]e)?"),
    (0.95, "available", r"(?:made )?available under(?: the)?(?: terms of(?: the)?)? {name}(?: licen[cs]e)?"),
    (0.95, "spdx", r"spdx licen[cs]e identifier {name}"),
    (0.8, "licen", r"{name} licen[cs]e"),
    (0.5, "", r"(?:see|under|use of)(?: the)? {name} licen[cs]e"),
)
#: Rules without a license name: label, strength, keywords, pattern.
NOTICES = (
    ("proprietary", 0.6, ("reserved",), r"all rights reserved"),
    ("proprietary", 0.7, ("proprietary",), r"proprietary and confidential"),
    ("copyright", 0.3, ("copyright",), r"copyright(?: c)? (?:19|20)\d\d"),
    ("public-domain", 0.9, ("domain",), r"(?:in|into|to) the public domain"),
    ("mit", 1.0, ("permission", "charge"), r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 0.9, ("permission", "purpose"), r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 0.9, ("redistribution",), r"redistribution and use in source and binary forms"),
    ("apache-2.0", 1.0, ("compliance",), r"you may not use this file except in compliance with the license"),
    ("gpl", 0.9, ("redistribute",), r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("no-warranty", 0.2, ("warranties",), r"without warranties or conditions of any kind"),
)


@dataclass(frozen=True)
class Rule:
    """A signature. Rules come in order of priority; ``base`` ones are reported whatever suppresses them."""
    label: str
    strength: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern
    base: bool = False


def _whole_words(pattern: str) -> re.Pattern:
    return re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])")


@cache
def rules() -> tuple[Rule, ...]:
    """All signatures, strongest first: every form around every name, the notices, and the base phrases."""
    named = [Rule(label, strength, tuple(k.encode() for k in {keyword, form} - {""}), _whole_words(pattern.replace("{name}", name)))
             for label, keyword, name in NAMES for strength, form, pattern in FORMS]
    bare = [Rule(label, 0.6, (keyword.encode(),), _whole_words(name)) for label, keyword, name in NAMES if "licen" in name or " by" in name]
    notices = [Rule(label, strength, tuple(k.encode() for k in keywords), _whole_words(pattern)) for label, strength, keywords, pattern in NOTICES]
    base = [Rule(label, 0.75, (phrase.split()[0].encode(),), _whole_words(phrase), True) for phrase, label in BASE]
    return tuple(sorted([*named, *notices, *bare, *base], key=lambda r: -r.strength))


@cache
def _gates() -> tuple[bytes, ...]:
    """Stems of which each rule's text holds one: a text without them needs no rule."""
    return (b"licen", b"copyright", b"reserved", b"spdx", b"public domain", b"proprietary", b"permission", b"redistribut", b"compliance", b"warranties",
            b"cc by", b"creative commons", b"cc0", b"released", b"distributed", b"available")


def detect(found: list[bytes]) -> list[tuple[str, float, int, int, bool, bool]]:
    """(label, strength, first word, words, base, kept) of every match, in order of priority.

    A match inside one of a rule of higher priority is suppressed, and so is one inside a longer
    match of the same strength.
    """
    joined = b" ".join(found)
    if not any(gate in joined for gate in _gates()):
        return []
    spans, starts = [], [0, *accumulate(len(w) + 1 for w in found)]
    for place, rule in enumerate(rules()):
        if all(k in joined for k in rule.keywords):
            for hit in rule.pattern.finditer(joined):
                start = bisect_right(starts, hit.start()) - 1
                spans.append((rule, place, start, start + hit[0].count(b" ") + 1))
    spans.sort(key=lambda s: (-s[0].strength, s[2] - s[3], s[1], s[2]))
    # Kept matches that no other one contains: in order of their starts they are in order of their ends too.
    out, firsts, lasts = [], [], []
    for rule, _, start, end in spans:
        at = bisect_right(firsts, start)
        kept = not (at and end <= lasts[at - 1])
        if kept:
            low = bisect_left(firsts, start)
            high = max(low, bisect_right(lasts, end))
            firsts[low:high], lasts[low:high] = [start], [end]
        out.append((rule.label, rule.strength, start, end - start, rule.base, kept))
    return out


DETECTION = "struct<label:string,strength:double,start:long,words:long,base:boolean,kept:boolean>"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, n_words, detections (array of label, strength, start, words, base, kept).

    Whole texts are scanned: A-Z are lowered, and words are runs of ASCII letters and digits and
    of all other characters beyond ASCII. Null counts as empty. Nothing is shuffled. A text
    without a stem of any rule skips the rules, and a rule is tried only on texts that hold its
    keywords. Repeated rows are scanned one by one; other columns are not looked at.
    """
    kind = pa.list_(pa.struct([("label", pa.string()), ("strength", pa.float64()), ("start", pa.int64()), ("words", pa.int64()), ("base", pa.bool_()), ("kept", pa.bool_())]))
    names = [f.name for f in kind.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits = [], []
            for body in batch.column(1).to_pylist():
                found = words(body)
                counts.append(len(found))
                hits.append([dict(zip(names, d)) for d in detect(found)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(hits, kind)], names=["id", "n_words", "detections"])

    rows = docs.select(F.col(key).cast("long").alias("id"), whole(text).alias("text"))
    return in_batches(rows, run, f"id long, n_words long, detections array<{DETECTION}>").withColumnRenamed("id", key)


def _labels(which: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(which, lambda d: d["label"]))), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = F.filter("detections", lambda d: d["base"])
    shown = F.filter("detections", lambda d: d["base"] | d["kept"])
    starts = F.transform(base, lambda d: d["start"])
    doubt = F.aggregate(F.filter("detections", lambda d: d["kept"]), F.lit(1.0), lambda acc, d: acc * (1 - d["strength"]))
    return scanned.withColumns({"n_base": F.size(base).cast("long"), "first_word": F.array_min(starts), "last_word": F.array_max(starts),
                                "base_labels": _labels(base), "labels": _labels(shown), "score": F.lit(1.0) - doubt}).drop("detections")
