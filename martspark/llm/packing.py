"""Packing along a Hilbert curve: alike documents share training sequences.

Each document becomes a hashed word vector, projected to a few dimensions;
its place on a Hilbert curve through that space is its key. Documents are
range-partitioned and sorted by the key, tokenized where they lie, and their
token streams are laid end to end and cut at the sequence length. A range's
last, partly filled sequence is cut into sequences of 1024, 512, ... tokens,
which need no padding.

Defined results: null and empty texts are the end token alone. Equal keys are ordered by id and row, so
a key that many documents share, or an id that many rows share, still spreads over ranges. Repeated rows are
packed each on their own; null ids sort first. An empty table gives no pieces.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import as_bytes, per_batch, released, sized, tidy, word_hashes

BUCKETS, DIMENSIONS, BITS = 512, 4, 12
#: Text in one range of the curve, which one task sorts and packs; documents sampled to find the ranges.
RANGE_BYTES, SAMPLED = 32 << 20, 200_000
#: Text whose distinct words are looked up together.
ENCODED_TEXT = 3 << 20
#: Words whose ids are laid out together.
LAID_WORDS = 1 << 16
#: Words that a Python worker remembers from lookup to lookup, those last seen; one lookup's (ENCODED_TEXT) come on top.
CACHED_WORDS = 250_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, curve_key long"


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, dimensions) below 2**bits; Skilling's transform."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[n - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, word number of each place, words of each text) of texts split at ASCII white space; null is empty."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    places = split.flatten().dictionary_encode()
    return places.dictionary, places.indices.to_numpy(), pc.list_value_length(split).to_numpy()


def _laid(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `ids` from `start` on, `size` long, one after the other."""
    ends = np.cumsum(size)
    return ids[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def curve_keys(texts: pa.Array) -> np.ndarray:
    """Hilbert keys of texts: log word counts in hashed buckets, unit length, randomly projected."""
    words, count = word_hashes(as_bytes(texts))
    where = np.repeat(np.arange(len(texts)) * BUCKETS, count) + (words % np.uint64(BUCKETS)).astype(np.int64)
    vectors = np.log1p(np.bincount(where, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS))
    vectors /= np.maximum(1e-9, np.sqrt((vectors * vectors).sum(axis=1)))[:, None]
    plane = np.random.default_rng(7).standard_normal((BUCKETS, DIMENSIONS))
    spot = (np.tanh(vectors @ plane) + 1) / 2
    return hilbert_key(np.minimum((spot * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


#: Marks that the tokenizer parts from letters and digits before them (no apostrophe, which may start `'s`).
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"


#: The tokenizer's end token between two words.
END = " <|endoftext|> "


class WordIds:
    """Token ids of texts, as little-endian unsigned 32-bit bytes, through a bounded memory of words.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids. New words
    are encoded together: words of letters two hundred at a time, told apart by their last tokens' `</w>`.
    Marks after a letter or digit are tokens of their own; after anything else (a quote, an ellipsis, a
    vowel sign) they may join it, so such words are encoded whole.

    Remembered words are one Arrow array beside arrays of their ids: a Python string and its bytes in a
    dictionary take several times the room. Only a lookup's new words are Python objects for a while.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.end = vocabulary[END.strip()]
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.new: dict[str, bytes] = {"": b""}  # of one lookup
        self.words = pa.array([], pa.large_string())
        self.ids, self.size, self.seen, self.lookups = np.zeros(0, "<u4"), np.zeros(0, np.int32), np.zeros(0, np.int32), 0
        self.marks = {"": b""}
        self.parted: dict[str, bool] = {}

    def parts(self, last: str) -> bool:
        """Whether marks after this character stand alone, by the tokenizer's own normal forms and classes."""
        if last not in self.parted:
            normal = self.tokenizer.normalizer.normalize_str(last + ".")
            self.parted[last] = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)[-1][0] == "."
        return self.parted[last]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _lines(self, words: list[str], between: str) -> Iterator[tuple[list[str], np.ndarray]]:
        """(words, token ids) of lines of two hundred words, few lines at a time: an encoding holds far more than its ids."""
        lines = [words[i:i + 200] for i in range(0, len(words), 200)]
        for i in range(0, len(lines), 16):
            some = lines[i:i + 16]
            for line, encoded in zip(some, self.tokenizer.encode_batch_fast([between.join(x) for x in some], add_special_tokens=False)):
                yield line, np.array(encoded.ids, "<u4")

    def _letters(self, words: list[str]) -> None:
        """Ids of words of letters, encoded in lines of two hundred."""
        for line, ids in self._lines(words, " "):
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(line) or ends[-1] != len(ids):  # a letter that the tokenizer parts
                self.new.update((w, self.whole(w)) for w in line)
                continue
            raw, at = ids.tobytes(), 0
            for word, end in zip(line, (4 * ends).tolist()):
                self.new[word] = raw[at:end]
                at = end

    def _apart(self, words: list[str]) -> None:
        """Ids of any words, encoded in lines of two hundred between end tokens, which the tokenizer cuts out first."""
        for line, ids in self._lines(words, END):
            ends = np.flatnonzero(ids == self.end)
            if len(ends) != len(line) - 1:  # a word that holds the end token itself
                self.new.update((w, self.whole(w)) for w in line)
                continue
            raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            for i, word in enumerate(line):
                self.new[word] = raw[cuts[i] + (4 if i else 0):cuts[i + 1] if i + 1 < len(cuts) else None]

    def learn(self, words: list[str]) -> None:
        """Put the ids of all of `words`, and of their cores, into `new`."""
        new, marks = self.new, self.marks
        fresh = [w for w in words if w not in new]
        plain = [w for w in fresh if w.isalpha() and len(w) <= 64]
        marked = [(w, w.rstrip(MARKS)) for w in fresh if not w.isalpha() or len(w) > 64]
        cores = {core for _, core in marked if core.isalpha() and len(core) <= 64}
        cores.difference_update(plain)
        self._letters(plain + [core for core in cores if core not in new])
        whole = [w for w, core in marked if core not in new or core and not self.parts(core[-1])]
        self._apart(whole)
        whole = set(whole)
        for word, core in marked:
            if word in whole:
                continue
            mark = word[len(core):]
            if mark not in marks:
                marks[mark] = self.whole(mark)
            new[word] = new[core] + marks[mark]

    def _spots(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, place in them of each word's first id, number of its ids) of distinct words; all are remembered."""
        cores = pc.utf8_rtrim(words, characters=MARKS)
        at = pc.index_in(pa.concat_arrays([words, cores]), value_set=self.words).fill_null(-1).to_numpy()
        at, core = at[:len(words)].copy(), at[len(words):]
        asked = (at < 0) & (core >= 0)
        first = np.cumsum(self.size, dtype=np.int64) - self.size
        recalled = {w: self.ids[first[i]:first[i] + self.size[i]].tobytes() for w, i in zip(cores.filter(pa.array(asked)).to_pylist(), core[asked])}
        self.new.update(recalled)
        fresh = words.filter(pa.array(at < 0)).to_pylist()
        self.learn(fresh)
        learned = fresh + list(self.new.keys() - recalled.keys() - {"", *fresh})
        parts = [self.new[w] for w in learned]
        self.new = {"": b""}
        if len(self.marks) > CACHED_WORDS:
            self.marks = {"": b""}
        at[at < 0] = len(self.words) + np.arange(len(fresh))
        known = pa.concat_arrays([self.words, pa.array(learned, pa.large_string())])
        ids = np.concatenate([self.ids, np.frombuffer(b"".join(parts), "<u4")])
        size = np.append(self.size, np.array([len(x) // 4 for x in parts], np.int32))
        seen = np.append(self.seen, np.full(len(learned), self.lookups, np.int32))
        seen[at] = self.lookups
        self.lookups += 1
        start = np.cumsum(size, dtype=np.int64) - size
        if len(known) > CACHED_WORDS:
            kept = np.sort(np.argpartition(seen, len(seen) - CACHED_WORDS)[-CACHED_WORDS:])
            self.words, self.ids, self.size, self.seen = known.take(pa.array(kept)), _laid(ids, start[kept], size[kept]), size[kept], seen[kept]
        else:
            self.words, self.ids, self.size, self.seen = known, ids, size, seen
        return ids, start[at], size[at]

    def of_texts(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; ids are found word by word for the distinct words, then laid out in place."""
        words, place, count = _words(texts)
        known, start, size = self._spots(words)
        reach, found = np.append(0, np.cumsum(count)), []
        part = reach[:-1] // LAID_WORDS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:]):
            own = place[reach[a]:reach[b]]
            ids = _laid(known, start[own], size[own])
            at = np.append(0, np.cumsum(size[own]))[reach[a:b + 1] - reach[a]]
            found += [ids[i:j].tobytes() for i, j in zip(at, at[1:])]
        return found


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A file of the public tokenizers that driver and executors have installed."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


#: A place on the curve: documents of one key are ordered by id, rows of one id by number.
PLACE = np.dtype([("key", np.int64), ("id", np.int64), ("row", np.int64)])


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))


def _keyed(bounds: np.ndarray):
    """A `mapInArrow` function that adds each document's curve key and range."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("row", pa.int64()), ("curve_key", pa.int64()), ("range", pa.int32())])

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).cast(pa.int64())
        own = np.zeros(batch.num_rows, PLACE)
        own["key"], own["id"], own["row"] = curve_keys(batch.column(1)), ids.fill_null(np.iinfo(np.int64).min).to_numpy(), batch.column(2).to_numpy()
        return pa.RecordBatch.from_arrays([ids, batch.column(1).cast(pa.string()), batch.column(2), pa.array(own["key"]), pa.array(np.searchsorted(bounds, own, side="right"), pa.int32())], schema=schema)
    return per_batch(of_batch, 256)


def curve_bounds(docs: DataFrame, range_bytes: int) -> np.ndarray:
    """Bounds that cut the curve into ranges of about `range_bytes` of text, from about SAMPLED rows at most.

    Rows are sampled by a hash of id and row number, so a repeated id is sampled like any other, and weighed
    by their bytes. Like the sample of Spark's own range partitioning they only balance the ranges; every document is placed.
    """
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    ranges = max(1, -(-(size or 0) // range_bytes))
    step = max(1, rows // min(SAMPLED, 100 * ranges))
    if ranges == 1:
        return np.zeros(0, PLACE)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "row"), F.lit(step)) == 0)
    found = sample.mapInArrow(_keyed(np.zeros(0, PLACE)), "doc_id long, text string, row long, curve_key long, range int").select(
        "curve_key", "doc_id", "row", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")).toArrow()
    spots = np.zeros(found.num_rows, PLACE)
    spots["key"], spots["id"], spots["row"] = found.column(0).to_numpy(), found.column(1).fill_null(np.iinfo(np.int64).min).to_numpy(), found.column(2).to_numpy()
    order = np.argsort(spots, order=["key", "id", "row"])
    reach = np.cumsum(found.column(3).to_numpy()[order].astype(np.int64) + 1)
    at = np.searchsorted(reach, np.arange(1, ranges) * (reach[-1] / ranges)) if len(order) else []
    return spots[order][at]


def pack(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 1, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Pieces of documents laid into sequences: each has its token ids, and its place in document and sequence."""
    end = np.array([end_id], "<u4").tobytes()
    docs = _numbered(docs)
    bounds = curve_bounds(docs, range_bytes)
    schema = pa.schema([(n, pa.binary() if t == "binary" else pa.int64()) for n, t in (x.split() for x in SCHEMA.split(", "))])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path)
        sequence, filled = TaskContext.get().partitionId() << 40, 0
        last: list[tuple] = []  # pieces of the sequence that is being filled
        ready: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in sized(batches, 1, ENCODED_TEXT):
            for doc_id, ids, key in zip(batch.column(0).to_pylist(), words.of_texts(batch.column(1)), batch.column(2).to_pylist()):
                ids += end
                start, total = 0, len(ids) // 4
                while start < total:
                    n = min(total - start, length - filled)
                    last.append((doc_id, start, n, ids[4 * start:4 * (start + n)], total, sequence, filled, key))
                    start, filled = start + n, filled + n
                    if filled == length:
                        ready += last
                        last, sequence, filled = [], sequence + 1, 0
            if ready:
                yield batch_of(ready)
                ready = []
            tidy()  # a lookup takes far more than the words it leaves
        size = 1
        while size * 2 <= filled:
            size *= 2
        room, offset = size, 0
        for doc_id, start, n, ids, total, _, _, key in last:
            while n:
                while room == 0:  # the next smaller power of two that what is left fills
                    sequence, offset, filled = sequence + 1, 0, filled - size
                    while size > filled:
                        size //= 2
                    room = size
                cut = min(n, room)
                ready.append((doc_id, start, cut, ids[:4 * cut], total, sequence, offset, key))
                start, n, ids, room, offset = start + cut, n - cut, ids[4 * cut:], room - cut, offset + cut
        if ready:
            yield batch_of(ready)

    placed = docs.mapInArrow(_keyed(bounds), "doc_id long, text string, row long, curve_key long, range int")
    return placed.select("doc_id", "text", "curve_key", "row", "range").repartitionById(len(bounds) + 1, "range") \
        .sortWithinPartitions("curve_key", "doc_id", "row").mapInArrow(released(packed), SCHEMA)


def pieces(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """`pack` with each piece's ids as their CRC-32."""
    packed = pack(docs, tokenizer_path, length, end_id)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "curve_key")
