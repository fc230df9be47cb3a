import tracemalloc
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from martspark.llm import packing as P

PATH = P.tokenizer_path()


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, length=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, own in pieces.items():
        ids, at = ids_of(texts[doc_id]), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:at], "<u4").tobytes())
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == length or at < length and at & (at - 1) == 0  # full, or a power of two


def test_round_trip(spark, words):
    texts = {i: words(20 + 37 * i % 900) for i in range(60)} | {100: None, 101: "", 102: "A<|endoftext|>b it's 12 É É  ", 103: "tab\x1fsep a\xa0b c\x85d", 104: "ΑΣ ΣΑΣ' ſ İ"}
    rows = P.pieces(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), PATH).collect()
    check(rows, texts)
    rows = P.pieces(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), PATH, length=64).collect()
    check(rows, texts, 64)
    rows = [r.asDict() | {"ids_crc32": zlib.crc32(r.ids)} for r in P.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), PATH, range_bytes=9000).collect()]
    check([SimpleNamespace(**r) for r in rows], texts)
    parts = {r["sequence_id"] >> 40 for r in rows}
    assert len(parts) > 5  # several ranges


def test_edges(spark, edge_documents, empty_documents):
    rows = P.pieces(edge_documents, PATH).collect()
    assert sum(r.doc_tokens for r in rows if r.doc_id in (1, 2, 6)) == 3
    assert sum(r.length for r in rows if r.doc_id == 3) == 2 * len(ids_of("word"))
    assert P.pieces(empty_documents, PATH).count() == 0


def test_hilbert_neighbours_differ_by_one_step():
    side = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    key = P.hilbert_key(side, 3)
    assert sorted(key) == list(range(512))
    path = side[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_copies_lie_side_by_side(spark, words):
    texts = [words(120) for _ in range(40)]
    rows = P.pack(spark.createDataFrame([(i, texts[i % 40]) for i in range(80)], "doc_id long, text string"), PATH).collect()
    key = {r.doc_id: r.curve_key for r in rows}
    assert all(key[i] == key[i + 40] for i in range(40)) and len(set(key.values())) > 20


@pytest.mark.parametrize("text", ["it's THE'll we're", "１２３ ½ a1b2", "é 가", "<|startoftext|> x", "漢字 かな　ハ", "a" * 500, "…—​z﻿ q"])
def test_words_are_tokenized_as_whole_texts_are(text):
    words = P.WordIds(PATH)
    for part in (text, f"The {text}, end. {text}. X{text}"):
        assert words.of_texts(pa.array([part, "a b"])) == [words.whole(part), words.whole("a b")]
        assert words.of_texts(pa.array([part, None])[:1]) == [words.whole(part)]  # now from memory


@pytest.mark.parametrize("core", ["dogs'", "word”", "की", "…", "İ", "x\u200b", "ⓐ", "\u0958", "“a”", "é", "ſ", "½", "a1", "ΑΣ", "가", "it's", "<|endoftext|>"])
def test_marks_after_a_word_known_before(core):
    for mark in (".", ",", "!?", ".)", "...", ";", "|"):
        words = P.WordIds(PATH)
        words.of_texts(pa.array([core, mark]))
        assert words.of_texts(pa.array([core + mark])) == [words.whole(core + mark)]


def test_one_id_in_a_third_of_the_rows_spreads_over_ranges(spark, words):
    often = words(120)
    rows = spark.createDataFrame([(7, often) if i % 3 == 0 else (1000 + i, words(120)) for i in range(1500)], "doc_id long, text string").repartition(4)
    numbered = P._numbered(rows)
    bounds = P.curve_bounds(numbered, 1 << 15)
    assert len(bounds) > 20
    placed = numbered.mapInArrow(P._keyed(bounds), "doc_id long, text string, row long, curve_key long, range int")
    size = {r["range"]: r["bytes"] for r in placed.groupBy("range").agg({"text": "count"}).withColumnRenamed("count(text)", "bytes").collect()}
    assert len(size) > 20 and max(size.values()) < 3 * 1500 / len(size)
    assert placed.where("doc_id = 7").select("range").distinct().count() > 5
    assert P.pack(rows, PATH, range_bytes=1 << 15).where("start = 0").count() == 1500


def test_words_with_marks_are_those_of_the_tokenizer(words):
    odd = ['"quoted', "l'eau", "<|endoftext|>", "a<|endoftext|>b", "3,14", "(x)", "\u2026.", "\u0915\u0940,", "it's", "don't.", "\u0130x", "#tag", "e-mail", "--", "'", "x\u201d."]
    known = P.WordIds(PATH)
    known.learn(odd)
    for word in odd:
        assert known.new[word] == known.whole(word), word
    assert known.of_texts(pa.array([" ".join(odd)])) == [known.whole(" ".join(odd))]


def test_encoding_and_layout_hold_little_at_once(words):
    """Few lines are encoded together, and ids are laid out part by part."""
    class Spy:
        def __init__(self, tokenizer):
            self.tokenizer, self.most = tokenizer, 0

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, lines, **kw):
            self.most = max(self.most, len(lines))
            return self.tokenizer.encode_batch_fast(lines, **kw)

    known = P.WordIds(PATH)
    known.tokenizer = Spy(known.tokenizer)
    letters, odd = ["".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(20_000)], [f"{i}'s" for i in range(20_000)]
    known.learn(letters + odd)
    assert 0 < known.tokenizer.most <= 16
    assert all(known.new[w] == known.whole(w) for w in letters[::997] + odd[::997])

    texts = [words(300) for _ in range(20)] + [None, ""]
    expected = [known.whole(t or "") for t in texts]
    many = pa.array(texts * 120)
    known.of_texts(many[:22])
    tracemalloc.start()
    try:
        found = known.of_texts(many)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == expected * 120
    assert peak < 3 * sum(map(len, found))  # 1.5 times; 6.8 when all was laid out at once


def test_words_remembered_stay_few(monkeypatch):
    """A lookup's words are forgotten down to CACHED_WORDS, those last seen stay, and ids are right either way."""
    monkeypatch.setattr(P, "CACHED_WORDS", 500)
    known = P.WordIds(PATH)
    lookups = [" ".join(f"{''.join(chr(97 + i // 26 ** k % 26) for k in range(4))}{',' if i % 5 == 0 else ''}" for i in range(n, n + 6000)) for n in (0, 6000, 12_000)]
    known.of_texts(pa.array(["warm up"]))
    tracemalloc.start()
    try:
        found = [known.of_texts(pa.array([text, "often seen, often"]))[0] for text in lookups]
        found = [x == known.whole(text) for x, text in zip(found, lookups)]
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert all(found)
    assert held < 300_000  # 12,000 words in two dictionaries before
    last = pa.array([lookups[0] + " often", "often"])
    assert known.of_texts(last) == [known.whole(t) for t in last.to_pylist()]
