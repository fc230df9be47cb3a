"""License scan: exact phrases, and short notices found despite small edits.

A notice with at most e edits is cut into e + 1 pieces; one piece must occur
unchanged (pigeonhole). Exact occurrences of the pieces give windows, in which
the `regex` library's bounded-error matching finds the notice, counts its
edits and reports its span. Texts are compared as lower-case words joined by
one space, so spans count words from 0 (the end is the first word after).

Defined results: null or empty texts have no words, no matches and score 0.
Repeated rows are scanned each on their own; null ids are kept; an empty
table gives an empty result. Whole texts are scanned, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martspark.llm.common import alnum_words, as_bytes, per_batch


@dataclass(frozen=True)
class Notice:
    label: str
    text: str  # lower-case words joined by one space
    edits: int


#: Phrases found at every place where their words stand consecutively.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices found with a bounded number of edits.
NOTICES = [
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("gpl", "gnu general public license version", 3),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 1),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
]

_MATCH = pa.struct([("label", pa.string()), ("edits", pa.int32()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("matched", pa.string()), ("similarity", pa.float64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("phrases", pa.list_(_MATCH)), ("notices", pa.list_(_MATCH))])
_DDL = "label: string, edits: int, start_word: bigint, end_word: bigint, matched: string, similarity: double"
SCHEMA = f"doc_id long, n_words long, phrases array<struct<{_DDL}>>, notices array<struct<{_DDL}>>"


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """(offset, piece): the notice cut into edits + 1 parts of nearly one length."""
    n, k = len(notice.text), notice.edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


def _word_numbers(text: str, places: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(first, last + 1) word of each span; spans sorted by start."""
    at, word = 0, 0
    for a, b in places:
        word += text.count(" ", at, a)
        at = a
        yield word, word + text.count(" ", a, b) + 1


def exact(text: str, phrase: str) -> list[tuple[int, int]]:
    """Spans of the phrase as whole words, overlapping ones too. text starts and ends with a space."""
    found, at = [], text.find(f" {phrase} ")
    while at >= 0:
        found.append((at + 1, at + 1 + len(phrase)))
        at = text.find(f" {phrase} ", at + 1)
    return found


def windows(text: str, notice: Notice, seeds: list[tuple[int, str]]) -> list[tuple[int, int]]:
    """Merged stretches of the text in which the notice could stand, by its exact pieces."""
    spans = []
    for offset, piece in seeds:
        at = text.find(piece)
        while at >= 0:
            spans.append((max(0, at - offset - notice.edits), at - offset + len(notice.text) + notice.edits))
            at = text.find(piece, at + 1)
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: list[Notice] = NOTICES) -> DataFrame:
    """doc_id, n_words, and all matches of phrases and of notices. Input: doc_id, text."""
    plans = [(n, pieces(n), regex.compile(f"(?e)(?:{regex.escape(n.text)}){{e<={n.edits}}}").pattern) for n in notices]
    seeds = sorted({p.encode() for _, parts, _ in plans for _, p in parts})
    keys = [f" {p} ".encode() for p in phrases]

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        compiled = [(n, parts, regex.compile(pattern)) for n, parts, pattern in plans]  # cached by the library
        counts, exacts, fuzzies = [], [], []
        for raw in as_bytes(batch.column(1)):
            words = alnum_words(raw)
            flat = b" " + b" ".join(words) + b" "
            counts.append(len(words))
            exacts.append([])
            fuzzies.append([])
            if any(k in flat for k in keys):
                text = flat.decode("utf-8", "replace")
                for phrase, label in phrases.items():
                    spans = exact(text, phrase)
                    exacts[-1] += [(label, 0, first - 1, end - 1, phrase, 1.0) for first, end in _word_numbers(text, spans)]
            if any(s in flat for s in seeds):
                text = flat.decode("utf-8", "replace")
                for notice, parts, pattern in compiled:
                    found = [m for a, b in windows(text, notice, parts) for m in pattern.finditer(text, a, b)]
                    spans = [(m.end() - len(m.group().lstrip()), m.start() + len(m.group().rstrip())) for m in found]
                    for m, (first, end) in zip(found, _word_numbers(text, spans)):
                        edits = sum(m.fuzzy_counts)
                        fuzzies[-1].append((notice.label, edits, first - 1, end - 1, m.group(), 1 - edits / len(notice.text)))
        names = [f.name for f in _MATCH]
        lists = [pa.array([[dict(zip(names, x)) for x in row] for row in rows], pa.list_(_MATCH)) for rows in (exacts, fuzzies)]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), *lists], schema=_SCHEMA)

    return docs.select("doc_id", "text").mapInArrow(per_batch(of_batch), SCHEMA)
