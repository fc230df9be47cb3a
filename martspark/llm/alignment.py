"""Alignment of two tokenizers' tokens over the same bytes.

A text is encoded by both tokenizers; every token covers a range of bytes.
Tokens of A and B are laid out together, sorted by start (lexsort), their ends
accumulated to a running maximum: a group breaks where a start reaches it.
Within a group every A token is linked with the B tokens that its bytes
overlap. A text of which either tokenizer can't give back the bytes has no
tokens. Where neither tokenizer joins words, groups and links are those of the
words, one after the other, so a task works them out once for each distinct word.

`summary` counts, for every linked pair of ids, its links in all documents and
scores each document by them. Tasks work in blocks of a few megabytes of text:
a block's distinct pairs go through the shuffle once with their number, and a
document keeps its links as places in its block's list of pairs. The corpus-wide
counts come back to the block by a join on the pair, and the block's
documents are scored together. Nothing that grows with the corpus is broadcast;
only the highest count of each B id, at most one row an id, is.

Defined results: null and empty texts have no tokens and count zero. A long
text is encoded whole and is a block of its own. Equal highest counts of one B
id are all best. Repeated rows are aligned each on their own and all count;
null ids are kept. Only doc_id and text are read, so other columns can have any
name. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import as_bytes, slices, stored

#: A block is closed at so many bytes of text or documents; tokens are made for so many bytes at a time.
BLOCK_BYTES, BLOCK_ROWS, SLICE_BYTES = 4 << 20, 20_000, 1 << 20

SPACE_MARK = "▁"
#: A space between visible characters: both tokenizers put it at a token's start and never join across it.
_FIRST, _LAST = r"[!-~\w]", rf"[^\s{SPACE_MARK}]"
_BETWEEN = re.compile(f" (?<={_LAST} )(?={_FIRST})")
_STARTS, _ENDS = re.compile(_FIRST), re.compile(_LAST)
#: Words that are encoded in one line.
LINE_WORDS = 200
#: A task keeps what it has worked out of words; beyond so many words, or characters of them, it starts anew.
HELD_WORDS, HELD_CHARACTERS = 300_000, 4 << 20


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible Latin-1 bytes for themselves, the others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0x100)} - {0xAD}
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Both tokenizers, and the bytes of their tokens.

    A's pattern starts a word at the space before it, and no entry of B holds a space mark behind another
    character, so neither has a token across a space between two visible characters. Texts are cut there
    and every distinct word is encoded once for the slices of a task, in lines of many words; sizes of tokens
    tell where a word's tokens end. Were B's entries otherwise, texts would be encoded whole.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        known, byte = self.a.get_vocab(), byte_of_letter()
        self.bytes_a = [b""] * (max(known.values()) + 1)
        for entry, i in known.items():
            self.bytes_a[i] = bytes(byte[c] for c in entry)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Written tokens by (id, what follows): ids of B behind those of A.
        self.written = [f"{i}{mark}".encode() for n in (len(self.bytes_a), len(self.bytes_b)) for i in range(n) for mark in (",", "|", ";", "")]
        self.by_words = not any(SPACE_MARK in self.b.id_to_piece(i).lstrip(SPACE_MARK) for i in range(self.b.get_piece_size()))
        self._forget()

    def _forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.place, self.characters, self.held, self.same = {}, 0, Aligned(none, none, none, none, none, []), np.zeros(0, bool)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def lines(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of lines with a space before each: ids by A, by B, ids of each line by A, by B, and whether both give its bytes back."""
        all_a = [x.ids for x in self.a.encode_batch_fast([" " + x for x in lines], add_special_tokens=False)]
        all_b = self.b.encode(lines, num_threads=1)
        same = np.zeros(len(lines), bool)
        for i, (line, a, b) in enumerate(zip(lines, all_a, all_b)):
            same[i] = b"".join(map(self.bytes_a.__getitem__, a)) == b" " + line.encode() == b"".join(map(self.bytes_b.__getitem__, b))
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (all_a, all_b))
        return *(np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((all_a, n_a), (all_b, n_b))), n_a, n_b, same

    def of_words(self, words: list[str], odd: set[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As `lines`, of each word. `odd` words can't stand in a line with others."""
        plain = [i for i, w in enumerate(words) if w not in odd]
        alone = [i for i, w in enumerate(words) if w in odd]
        groups = [plain[i:i + LINE_WORDS] for i in range(0, len(plain), LINE_WORDS)]
        a, b, n_a, n_b, same = self.lines([" ".join([words[i] for i in g]) for g in groups])
        if not same.all():  # find the words that a tokenizer doesn't give back
            return self.lines(words)
        size = np.array([1 + len(words[i].encode()) for i in plain], np.int64)
        ends = np.cumsum(size)
        counts = []
        for ids, of in ((a, self.size_a), (b, self.size_b)):
            reach = np.cumsum(of[ids])
            last = np.searchsorted(reach, ends)
            if not np.array_equal(reach[last], ends):
                return self.lines(words)
            counts.append(np.diff(last + 1, prepend=0))
        if not alone:
            return a, b, *counts, np.ones(len(words), bool)
        a2, b2, n_a2, n_b2, same2 = self.lines([words[i] for i in alone])
        # Back to the order of `words`: plain ones were encoded first.
        order = np.argsort(np.array(plain + alone, np.int64), kind="stable")
        out_a, n_a = gathered(np.concatenate([a, a2]), np.concatenate([counts[0], n_a2]), order)
        out_b, n_b = gathered(np.concatenate([b, b2]), np.concatenate([counts[1], n_b2]), order)
        return out_a, out_b, n_a, n_b, np.concatenate([np.ones(len(plain), bool), same2])[order]

    def of_known(self, words: list[str], odd: set[str]) -> tuple[np.ndarray, Aligned, np.ndarray]:
        """(place of each word, what is known at the places, whether both give the word back). Words of earlier calls are looked up."""
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if new:
            a, b, n_a, n_b, same = self.of_words(new, odd)
            if not same.all():
                a, b, n_a, n_b = a[np.repeat(same, n_a)], b[np.repeat(same, n_b)], n_a * same, n_b * same
            old, found = self.held, aligned(self, a, n_a, b, n_b)
            self.held = Aligned(*(np.concatenate([getattr(old, n), getattr(found, n)]) for n in ("n_a", "n_b", "n_groups", "n_links", "pairs")), old.groups + found.groups)
            self.same = np.concatenate([self.same, same])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.characters += sum(map(len, new))
        out = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words)), self.held, self.same
        if not self.by_words or len(self.place) > HELD_WORDS or self.characters > HELD_CHARACTERS:
            self._forget()
        return out


def gathered(values: np.ndarray, size: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of `values` (run i has size[i] entries) in the order of `pick`, end to end, and their sizes."""
    n = size[pick]
    start = (np.cumsum(size) - size)[pick]
    return values[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())], n


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each interval, numbered from 0 by place: a group breaks where a start reaches the running maximum of ends."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.zeros(len(starts), np.int64)
    group[order[1:]] = np.cumsum(starts[order][1:] >= reach[:-1])
    return group


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count per A interval, B number of each pair) of all overlapping pairs, A by A; B sorted and disjoint."""
    first = np.searchsorted(end_b, start_a, side="right")
    count = np.searchsorted(start_b, end_a, side="left") - first
    return count, np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


@dataclass
class Aligned:
    """Tokens, groups and links of some texts; arrays hold one entry a text but for `pairs`."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray  # A id << 32 | B id of every link, text by text
    groups: list[bytes]  # `a1,a2|b1;a3|b2,b3`


def align(tokens: Tokens, texts: list[bytes]) -> Aligned:
    """No tokens where either tokenizer doesn't give the bytes back."""
    plain = [t.decode("utf-8", "replace") for t in texts]
    parts = [(_BETWEEN.split(t) if tokens.by_words else [t]) if t else [] for t in plain]
    odd = {p[0] for p in parts if p and not _STARTS.match(p[0])} | {p[-1] for p in parts if p and not _ENDS.match(p[-1][-1])}
    if not tokens.by_words:
        odd = set(plain)
    place, known, same = tokens.of_known(list(chain.from_iterable(parts)), odd)
    of = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    whole = np.array([p == t.encode() for p, t in zip(texts, plain)], bool)
    whole[of[~same[place]]] = False
    place, of = place[whole[of]], of[whole[of]]
    counts = [np.bincount(of, n[place], len(texts)).astype(np.int64) for n in (known.n_a, known.n_b, known.n_groups, known.n_links)]
    words, cuts = place.tolist(), [0, *np.cumsum(np.bincount(of, minlength=len(texts))).tolist()]
    groups = [b";".join(map(known.groups.__getitem__, words[i:j])) for i, j in zip(cuts, cuts[1:])]
    return Aligned(*counts, gathered(known.pairs, known.n_links, place)[0], groups)


def aligned(tokens: Tokens, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> Aligned:
    """Of texts given as ids by A and B, end to end, and ids of each text."""
    # Both cover the same bytes of each text, so places in the joined texts agree.
    end_a, end_b = np.cumsum(tokens.size_a[a]), np.cumsum(tokens.size_b[b])
    start_a, start_b = end_a - tokens.size_a[a], end_b - tokens.size_b[b]
    group = coalesce(np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b]))
    count, other = overlaps(start_a, end_a, start_b, end_b)

    last_a = np.cumsum(n_a)
    some = n_a > 0
    n_groups = np.zeros(len(n_a), np.int64)
    n_groups[some] = np.diff(group[last_a[some] - 1], prepend=-1)
    n_links = np.diff(np.append(0, np.cumsum(count))[last_a], prepend=0)
    pairs = np.repeat(a, count) << 32 | b[other]

    # Groups in order, A's tokens before B's; what follows a token tells its mark.
    side = 2 * group + np.repeat([0, 1], [len(a), len(b)])
    order = np.argsort(side, kind="stable")
    side = side[order]
    step = np.diff(side, append=-2)
    mark = np.where(step == 0, 0, np.where((step == 1) & (side % 2 == 0), 1, 2))
    ends = np.cumsum(n_a + n_b)
    mark[ends[some] - 1] = 3
    words = (4 * np.concatenate([a, b + len(tokens.bytes_a)])[order] + mark).tolist()
    cuts = [0, *ends.tolist()]
    groups = [b"".join(map(tokens.written.__getitem__, words[i:j])) for i, j in zip(cuts, cuts[1:])]
    return Aligned(n_a, n_b, n_groups, n_links, pairs, groups)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(ids, texts) of about SLICE_BYTES, a longer text alone."""
    for batch in slices(batches, 256):
        ids, texts = batch.column(0).cast(pa.int64()), as_bytes(batch.column(1))
        at = size = 0
        for i, text in enumerate(texts):
            if size and size + len(text) > SLICE_BYTES:
                yield ids.slice(at, i - at), texts[at:i]
                at, size = i, 0
            size += len(text)
        if at < len(texts):
            yield ids.slice(at), texts[at:]


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links and the groups of every text, written `a1,a2|b1;a3|b2,b3`; '' without tokens."""
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")], ("groups", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path_a, path_b)
        for ids, texts in _pieces(batches):
            found = align(tokens, texts)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array([g.decode() for g in found.groups], pa.string())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string")


def planes(numbers: np.ndarray) -> bytes:
    """Sorted numbers as differences, bytes of one weight together: mostly zeros, which compress well."""
    return np.diff(numbers, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.int64)) if raw else np.zeros(0, np.int64)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_BLOCKS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *[(n, pa.int64()) for n in _COUNTS], ("groups_sha256", pa.string()), ("places", pa.binary()),
                     ("place", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
_BLOCKS_DDL = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, place long, a int, b int, n long"


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of two kinds. Documents: counts, hash of the groups, and links as places in the block's pairs. Pairs: place, a, b and links n."""

    def rows_of(block: int, ids: list, done: list[Aligned], sha: list[str]) -> Iterator[pa.RecordBatch]:
        found = pa.array(np.concatenate([x.pairs for x in done])).dictionary_encode()
        keys = found.dictionary.to_numpy()
        order = np.argsort(keys)
        number = np.argsort(order)[found.indices.to_numpy()]
        keys, times = keys[order], np.bincount(number, minlength=len(keys))
        counts = [np.concatenate([getattr(x, n) for x in done]) for n in _COUNTS]
        cuts = np.append(0, np.cumsum(counts[-1]))
        places = [planes(np.sort(number[i:j])) for i, j in zip(cuts, cuts[1:])]
        for at in range(0, len(sha), 1000):
            to = min(at + 1000, len(sha))
            yield _filled(to - at, block=np.full(to - at, block), doc_id=pa.concat_arrays(ids).slice(at, to - at),
                          groups_sha256=pa.array(sha[at:to], pa.string()), places=pa.array(places[at:to], pa.binary()), **dict(zip(_COUNTS, (c[at:to] for c in counts))))
        for at in range(0, len(keys), 100_000):
            some = keys[at:at + 100_000]
            yield _filled(len(some), block=np.full(len(some), block), place=at + np.arange(len(some)), a=(some >> 32).astype(np.int32), b=(some & 0xFFFFFFFF).astype(np.int32),
                          n=times[at:at + 100_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path_a, path_b)
        block, size, ids, done, sha = TaskContext.get().partitionId() << 32, 0, [], [], []
        for part, texts in _pieces(batches):
            if done and (size + sum(map(len, texts)) > BLOCK_BYTES or len(sha) >= BLOCK_ROWS):
                yield from rows_of(block, ids, done, sha)
                block, size, ids, done, sha = block + 1, 0, [], [], []
            found = align(tokens, texts)
            sha += [hashlib.sha256(g).hexdigest() if g else "" for g in found.groups]
            found.groups = []
            size += sum(map(len, texts))
            ids.append(part)
            done.append(found)
        if done:
            yield from rows_of(block, ids, done, sha)

    return docs.select("doc_id", "text").mapInArrow(run, _BLOCKS_DDL)


def _filled(rows: int, **known) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(known[f.name], f.type) if f.name in known else pa.nulls(rows, f.type) for f in _BLOCKS], schema=_BLOCKS)


def pair_counts(parts: DataFrame) -> DataFrame:
    """a, b, links of the pair in all documents, and whether that is the highest of the pair's B id. Input: `blocks`."""
    counts = stored(parts.where("place is not null").groupBy("a", "b").agg(F.sum("n").alias("links")), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("links").alias("highest"))  # at most one row for each id of B
    return counts.join(F.broadcast(highest), "b").select("a", "b", "links", (F.col("links") == F.col("highest")).alias("best"))


def summary(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is best), count_sum (of the links' pair counts), groups_sha256."""
    parts = stored(blocks(docs, path_a, path_b), "aligned")
    pairs = parts.where("place is not null").join(pair_counts(parts), ["a", "b"]).select(F.col("block").alias("its"), "place", "links", "best")
    texts = parts.where("place is null").select("block", "doc_id", *_COUNTS, "groups_sha256", "places")
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in (*_COUNTS, "n_best", "count_sum")], ("groups_sha256", pa.string())])

    def scored(own: pa.Table, known: pa.Table) -> pa.Table:
        links, best = np.zeros(known.num_rows, np.int64), np.zeros(known.num_rows, np.int64)
        place = known["place"].to_numpy()
        links[place], best[place] = known["links"].to_numpy(), known["best"].to_numpy()
        each = [from_planes(raw) for raw in own["places"].to_pylist()]
        new = [pa.array([int(values[x].sum()) for x in each], pa.int64()) for values in (best, links)]
        return pa.Table.from_arrays([own["doc_id"], *(own[n] for n in _COUNTS), *new, own["groups_sha256"]], schema=schema)

    return texts.groupBy("block").cogroup(pairs.groupBy("its")).applyInArrow(
        scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
