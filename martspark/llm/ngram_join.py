"""N-gram Jaccard self-join by PartEnum signatures, and its connected components.

A document's set is its distinct five-word shingles. Two sets of Jaccard
similarity 3/4 or more differ in at most (|A| + |B|) / 7 features. The feature
domain is cut into partitions, as fine as the band of set sizes asks; every
first-level partition has two second-level ones of which one may differ
(n2 = 2, k2 = 1), so the enumerated subsets are the single partitions. Sets
of one band that are similar enough agree on more partitions than can
differ, hence share a signature (a partition's whole content).

Which signatures are written, without losing a pair:
* Empty partitions are none. A set with more non-empty partitions than can
  differ writes only as many as can differ, plus one: fullest partitions first,
  an order that both sides of a pair share.
* Features that very many documents have are left out of the partitions
  (differences only get fewer). A set with too few other partitions also
  writes single features: a quarter of its own may be missing in the other,
  so a quarter, plus one, of them does, the commonest last.
* Bands double in size. A set up to 4/3 of the next smaller band's end
  also writes that band's signatures.

Sets that share a signature are verified exactly: each with the group's
first set and with its neighbour, which are all pairs of up to three sets. Then all pairs across the
components of small groups, which are done with that; in larger ones, in two rounds, each set with the nearest of
another component, then all pairs across the components that are left. An odd sketch (parities of hashed features) whose bits differ
in more places than the sets may, rules a pair out inside the task. Pairs inside a component
need no test, so copies are never expanded into all pairs, and no pair is lost.

Equal sets are one node, with a number of its own (found by a 128-bit hash); features are 64-bit hashes.
Defined results: null texts and texts without words have an empty set and are linked with
nothing; null ids get a null component; rows that repeat an id are compared
each on their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import U, as_bytes, mix, per_batch, picked, released, slices, stored, without, word_hashes
from martspark.llm.components import connected_components

SHINGLE = 5
#: Rows that a group comparison holds at a time; larger groups are cut into pairs of blocks.
BLOCK = 2048
#: Groups of up to so many rows are compared together, array by array.
SMALL = 24
#: Features that are told apart as common: tasks report what they saw at least so often, then it counts
#: how often that is in all tasks, and the commonest are taken. A task's own share doesn't grow with the corpus.
COMMON_IN_TASK, COMMON_OVERALL, COMMON_FEATURES = 2, 8, 100_000
#: Features that a task holds before it counts them.
HELD_FEATURES = 500_000
#: Rounds of nearest pairs before all pairs are tested; they only spare work. Groups of up to SMALL sets are tested whole in the first.
NEAREST_ROUNDS = 2
#: In groups of up to so many sets, the first set and the neighbour of each make all the pairs.
SETTLED = 3
#: Odd factors of a shingle's words and of their number.
FACTORS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], U)
LENGTH = U(0x8EBC6AF09C88C6E3)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, ends): each text's distinct shingles, sorted, one after the other."""
    words, n = word_hashes(texts)
    first = np.cumsum(n) - n
    flat = np.concatenate([words, np.zeros(SHINGLE - 1, U)])
    h = np.full(len(words), SHINGLE, U) * LENGTH
    for i, factor in enumerate(FACTORS):
        h += flat[i:len(words) + i] * factor
    few = np.flatnonzero((n > 0) & (n < SHINGLE))  # the whole text is one shingle
    if len(few):
        at = first[few]
        h[at] = n[few].astype(U) * LENGTH
        for i, factor in enumerate(FACTORS[:-1]):
            h[at] += np.where(n[few] > i, flat[at + i] * factor, U(0))
    width = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    ends = np.cumsum(width)
    h = mix(h[np.repeat(first - ends + width, width) + np.arange(width.sum())])
    for a, b in zip(ends - width, ends):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[(ends - width)[width > 0]] = True
    return h[new], np.append(0, np.cumsum(new))[ends]


def sketch_bits(n: int) -> int:
    """Bits of the odd sketch of a set of n features: a power of two."""
    return max(64, 4 << max(0, n - 1).bit_length())


def odd_sketch(features: np.ndarray) -> bytes:
    """Parities of the features hashed to `sketch_bits` places: sets that differ in d features differ in at most d bits."""
    m = sketch_bits(len(features))
    place = (mix(features + U(77)) & U(m - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=m) & 1).astype(np.uint8)).tobytes()


def coarse(sketch: bytes) -> bytes:
    """A sketch at a quarter of its bits, for the first test of many pairs."""
    return folded(np.frombuffer(sketch, np.uint8), max(64, 2 * len(sketch))).tobytes()


def folded(sketches: np.ndarray, bits: int) -> np.ndarray:
    """Sketches (bytes in the last axis) brought to fewer bits: halves laid over each other."""
    while sketches.shape[-1] * 8 > bits:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return np.ascontiguousarray(sketches).view(U)


def bits_apart(sa: list[bytes], sb: list[bytes]) -> np.ndarray:
    """Places in which each pair of sketches differs: at most the sets' differing features."""
    la, lb = np.array([len(x) for x in sa], np.int64), np.array([len(x) for x in sb], np.int64)
    apart = np.zeros(len(sa), np.int64)
    for x, y in set(zip(la.tolist(), lb.tolist())):
        pick = np.flatnonzero((la == x) & (lb == y))
        a, b = (folded(np.frombuffer(b"".join([s[i] for i in pick]), np.uint8).reshape(len(pick), -1), 8 * min(x, y)) for s in (sa, sb))
        apart[pick] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return apart


def within(sa: list[bytes], sb: list[bytes], total: np.ndarray) -> np.ndarray:
    """Whether each pair of sketches differs in at most total / 7 bits; total: the sets' sizes added."""
    return 7 * bits_apart(sa, sb) <= total


def _ranked(doc: np.ndarray, n: int) -> np.ndarray:
    """Place of each row within its document; rows sorted by document."""
    return np.arange(len(doc)) - np.searchsorted(doc, np.arange(n))[doc]


def band_signatures(h: np.ndarray, doc: np.ndarray, band: np.ndarray, need: np.ndarray, lone: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document) of sets in the given bands. Features sorted by document and value.

    need: most differences + 1; lone: most features that the other set may lack, + 1.

    common: common features sorted by value, and how common each is (its rank).
    """
    n = len(band)
    common, rank = common
    size = 2.0 ** band
    parts = np.where(size <= 32, 2 * size, np.ceil(0.5 * size))
    if len(common):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        hot = common[at] == h
        often = np.where(hot, rank[at], -1)
    else:
        hot, often = np.zeros(len(h), bool), np.full(len(h), -1)
    rare, of = h[~hot], doc[~hot]
    part = ((rare >> U(11)).astype(np.float64) * (parts[of] / 2.0 ** 53)).astype(np.int64)
    new = np.ones(len(rare), bool)
    new[1:] = (of[1:] != of[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    of, part = of[first], part[first]
    content = np.add.reduceat(mix(rare), first) if len(first) else np.zeros(0, U)
    full = np.diff(np.append(first, len(rare)))
    sign = mix(content + mix((part * 64 + band[of]).astype(U)))
    order = np.lexsort((sign, -full, of))
    sign, of = sign[order], of[order]
    few = np.bincount(of, minlength=n) < need
    keep = _ranked(of, n) < need[of]
    # Sets with too few partitions: single features, the commonest last.
    own = few[doc]
    h1, doc1 = h[own], doc[own]
    order = np.lexsort((h1, often[own], doc1))
    h1, doc1 = h1[order], doc1[order]
    keep1 = _ranked(doc1, n) < lone[doc1]
    single = mix(h1 + (band[doc1] + 1000).astype(U))
    return np.concatenate([sign[keep], single[keep1]]), np.concatenate([of[keep], doc1[keep1]])


def signatures(features: np.ndarray, ends: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document) of all sets; sets of one or two features can only equal another."""
    n = np.diff(np.append(0, ends))
    doc = np.repeat(np.arange(len(n)), n)
    out = []
    band = np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)
    below = 2 ** np.maximum(band - 1, 0)  # the end of the next smaller band
    for picked, level, need in ((n >= 3, band, n // 3 + 1), ((n >= 3) & (3 * n <= 4 * below), band - 1, (n + below) // 7 + 1)):
        number = np.cumsum(picked) - 1
        mine = picked[doc]
        s, d = band_signatures(features[mine], number[doc[mine]], level[picked], need[picked], n[picked] // 4 + 1, common)
        out.append((s, np.flatnonzero(picked)[d]))
    return np.concatenate([s for s, _ in out]), np.concatenate([d for _, d in out])


def _set_hash(features: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_digest(features.tobytes())
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _hashes(features: np.ndarray, ends: np.ndarray) -> np.ndarray:
    cuts = np.append(0, ends)
    return np.array([_set_hash(features[a:b]) for a, b in zip(cuts, cuts[1:])], np.int64).reshape(-1, 2)


def counted(old: tuple[np.ndarray, np.ndarray], fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, count) sorted by value, with the values of `fresh` counted in; values that stand once are forgotten."""
    known, total = old
    value, n = np.unique(fresh, return_counts=True)
    at = np.searchsorted(known, value)
    seen = at < len(known)
    seen[seen] = known[at[seen]] == value[seen]
    total = total.copy()
    total[at[seen]] += n[seen]
    new = ~seen & (n >= 2)
    value, total = np.concatenate([known, value[new]]), np.concatenate([total, n[new]])
    order = np.argsort(value)
    return value[order], total[order]


def describe(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, n, h1, h2, sketch), and rows (feature, df) of features common in a task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sketch", pa.binary()), ("coarse", pa.binary()), ("feature", pa.int64()), ("df", pa.int64()), ("text_hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.zeros(0, U), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        for batch in slices(batches, 256):
            features, ends = shingle_sets(as_bytes(batch.column(1)))
            cuts = np.append(0, ends)
            n = np.diff(cuts)
            sketches = [odd_sketch(features[a:b]) if b - a >= 3 else None for a, b in zip(cuts, cuts[1:])]
            h = _hashes(features, ends)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(sketches, pa.binary()), pa.array([x and coarse(x) for x in sketches], pa.binary()), none, none, batch.column(2)], schema=schema)
            held.append(features)
            if sum(map(len, held)) > HELD_FEATURES:
                common = counted(common, np.concatenate(held))
                held.clear()
        if held or len(common[0]):
            value, total = counted(common, np.concatenate([np.zeros(0, U), *held]))
            often = total >= COMMON_IN_TASK
            none = pa.nulls(int(often.sum()), pa.int64())
            blank = pa.nulls(len(none), pa.binary())
            yield pa.RecordBatch.from_arrays([none, none, none, none, blank, blank, pa.array(value[often].view(np.int64)), pa.array(total[often]), none], schema=schema)

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(released(run), "doc_id long, n long, h1 long, h2 long, sketch binary, coarse binary, feature long, df long, text_hash long")


def common_features(rows: DataFrame) -> list[int]:
    """The commonest features of all documents, rarest first. Input: `describe`."""
    seen = rows.where("feature is not null").groupBy("feature").agg(F.sum("df").alias("df")).where(F.col("df") >= COMMON_OVERALL)
    return [r.feature for r in seen.orderBy(F.desc("df"), "feature").limit(COMMON_FEATURES).collect()][::-1]


def write_signatures(docs: DataFrame, common: list[int]) -> DataFrame:
    """(signature, h1) of every document with an id. common: features sorted by how common they are, rarest first."""
    features = np.array(common, np.int64).view(U)
    rank = np.argsort(features)  # in order of value, how common each is
    ranked = (features[rank], rank)
    schema = pa.schema([("signature", pa.int64()), ("h1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            features, ends = shingle_sets(as_bytes(batch.column(0)))
            sign, doc = signatures(features, ends, ranked)
            yield pa.RecordBatch.from_arrays([pa.array(sign.view(np.int64)), pa.array(_hashes(features, ends)[doc, 0])], schema=schema)

    return docs.where("doc_id is not null").select("text").mapInArrow(released(run), "signature long, h1 long")


def shared_signatures(rows: DataFrame) -> DataFrame:
    """(signature, h1, first, before) of signatures that two or more sets share, in one sorted pass.

    first: the group's smallest h1; before: the one before this (its own for the first).
    """
    schema = pa.schema([(c, pa.int64()) for c in ("signature", "h1", "first", "before")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros((0, 2), np.int64)  # the last distinct row so far, not yet given out unless `shared`
        first, shared = 0, False
        for batch in batches:
            rows = np.concatenate([last, np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)])
            if not len(rows):
                continue
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
            rows = rows[new]
            head = np.ones(len(rows), bool)
            head[1:] = rows[1:, 0] != rows[:-1, 0]
            group = np.cumsum(head) - 1
            size = np.bincount(group)
            firsts = rows[head, 1]
            known = shared and len(last) > 0
            if len(last):
                firsts[0] = first
            many = size > 1
            if known:
                many[0] = True
            give = many[group]
            if known:
                give[0] = False  # given out before
            out, before = rows[give], np.where(head, rows[:, 1], np.roll(rows[:, 1], 1))
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1]), pa.array(firsts[group][give]), pa.array(before[give])], schema=schema)
            first, shared, last = int(firsts[-1]), bool(many[-1]), rows[-1:]

    return rows.repartition("signature").sortWithinPartitions("signature", "h1").mapInArrow(run, "signature long, h1 long, first long, before long")


def _may_link(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    return 4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)


def promising(pairs: DataFrame) -> DataFrame:
    """(a, b) of pairs that sizes and sketches don't rule out. Input: a, b, na, nb, sa, sb."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
        keep = _may_link(na, nb) & within(batch.column(4).to_pylist(), batch.column(5).to_pylist(), na + nb)
        return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], schema=schema)

    return pairs.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(per_batch(of_batch, 2048), "a long, b long")


def nearest_pairs(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Numbers of the pairs that are the nearest of either side; at most one a side, the first of equals."""
    pick = []
    for side in (a, b):
        order = np.lexsort((np.arange(len(side)), apart, side))
        new = np.ones(len(order), bool)
        new[1:] = side[order[1:]] != side[order[:-1]]
        pick.append(order[new])
    return np.unique(np.concatenate(pick))


def across(members: DataFrame, nearest: bool = False) -> DataFrame:
    """Promising pairs (a < b) of different components within each group. Input: signature, i, j, block, node, n, sketch, component.

    A group is (signature, i, j): sets of blocks i and j of a signature. nearest: all pairs of groups of up
    to SMALL sets, fewer than SMALL / 2 for each set; of the pairs that larger whole groups hold together in a task,
    only each set's nearest.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def small_groups(group: np.ndarray, size: np.ndarray, may) -> list[np.ndarray]:
        """Index pairs within groups of up to SMALL rows, for all groups at once: rows at each distance."""
        found = [np.zeros((0, 2), np.int64)]
        low = size[group] <= SMALL
        for d in range(1, min(SMALL, int(size.max())) if low.any() else 1):
            x = np.flatnonzero(low[:-d] & (group[:-d] == group[d:]))
            x = x[may(x, x + d)]
            found.append(np.stack([x, x + d], axis=1))
        return found

    def large_group(at: np.ndarray, component: np.ndarray, may) -> list[np.ndarray]:
        """Index pairs between what is outside the group's largest component and all of the group."""
        value, count = np.unique(component[at], return_counts=True)
        found = []
        for x in at[component[at] != value[count.argmax()]]:
            near = at[may(np.full(len(at), x), at)]
            found.append(np.stack([np.full(len(near), x), near], axis=1))
        return found

    def compare(keys, block, node, n, component, sketch) -> np.ndarray:
        """(a, b) of promising pairs in whole groups, rows sorted by group."""
        head = np.ones(len(keys), bool)
        head[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        group = np.cumsum(head) - 1
        size, first = np.bincount(group), np.flatnonzero(head)
        one = keys[:, 1] == keys[:, 2]  # a group of one block: all its pairs count

        def may(x, y):
            return (component[x] != component[y]) & (one[x] | (block[x] != block[y])) & _may_link(n[x], n[y])

        found = small_groups(group, size, may)
        of_small = sum(map(len, found))
        for g in np.flatnonzero(size > SMALL):
            found += large_group(np.arange(first[g], first[g] + size[g]), component, may)
        x, y = np.concatenate(found).T
        pairs, where = np.unique(np.stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y])], axis=1), axis=0, return_index=True)
        x, y, in_small = x[where], y[where], where < of_small
        total = n[x] + n[y]
        small = {}
        for k in np.unique(np.concatenate([x, y])).tolist():
            small[k] = coarse(sketch[k])
        apart = np.full(len(pairs), np.iinfo(np.int64).max // 8)
        for cut in range(0, len(pairs), 1 << 15):  # at few bits first, then at all
            part = np.arange(cut, min(cut + (1 << 15), len(pairs)))
            part = part[within([small[k] for k in x[part]], [small[k] for k in y[part]], total[part])]
            apart[part] = bits_apart([sketch[k] for k in x[part]], [sketch[k] for k in y[part]])
        ok = np.flatnonzero(7 * apart <= total)
        if nearest:
            keep = in_small[ok]
            keep[nearest_pairs(pairs[ok, 0], pairs[ok, 1], apart[ok])] = True
            ok = ok[keep]
        return pairs[ok]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the group that the next batch may go on with

        def give(pairs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in range(6)]
            rows = [np.stack(cols[:3], axis=1), *cols[3:], batch.column(7).to_numpy(), batch.column(6).to_pylist()]
            if held is not None:
                rows = [a + b if isinstance(a, list) else np.concatenate([a, b]) for a, b in zip(held, rows)]
            if not len(rows[0]):
                continue
            change = np.flatnonzero((rows[0][1:] != rows[0][:-1]).any(axis=1))
            last = change[-1] + 1 if len(change) else 0
            held = [x[last:] for x in rows]
            if last:
                yield give(compare(*(x[:last] for x in rows)))
        if held is not None:
            yield give(compare(*held))

    return members.select("signature", "i", "j", "block", "node", "n", "sketch", "component").repartition("signature", "i", "j") \
        .sortWithinPartitions("signature", "i", "j").mapInArrow(released(run), "a long, b long")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) of which the sets link: 100 * intersection >= 75 * union. a, b: nodes of classes."""
    own = classes.select("h1", "h2", "node", F.col("first_id").alias("doc_id")).join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("features", pa.binary())])

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        features, ends = shingle_sets(as_bytes(batch.column(1)))
        cuts = np.append(0, ends)
        h = _hashes(features, ends)
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array([features[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], schema=schema)

    texts = docs.select("doc_id", "text").join(own.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = stored(
        texts.mapInArrow(per_batch(of_batch, 256), "doc_id long, h1 long, h2 long, features binary")
        .join(own, ["h1", "h2", "doc_id"]).dropDuplicates(["node"]).select("node", "features"), "sets")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), U) for v in (x, y))
            both = len(x) + len(y) - len(np.union1d(x, y))
            ok.append(100 * both >= 75 * (len(x) + len(y) - both))
        return pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok, pa.bool_())), batch.column(1).filter(pa.array(ok, pa.bool_()))], schema=out)

    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("features").alias("fa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("features").alias("fb")), "b")
        .select("a", "b", "fa", "fb").mapInArrow(per_batch(check, 256), "a long, b long")
    )


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash for every row. Input: doc_id, text."""
    docs = docs.select("doc_id", "text")
    rows = stored(describe(docs), "sets-described")
    common = common_features(rows)
    base = rows.where("feature is null")
    classes = stored(
        base.where("doc_id is not null and n > 0").groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "n", "sketch", "coarse")).alias("c"))
        .select("h1", "h2", F.monotonically_increasing_id().alias("node"), F.col("c.doc_id").alias("first_id"), F.col("c.n").alias("n"), F.col("c.sketch").alias("sketch"), F.col("c.coarse").alias("coarse")), "classes")
    shared = stored(shared_signatures(write_signatures(docs, common)), "shared-signatures")
    known = classes.where("n >= 3").select("h1", "node", "n")

    def tested(pairs: DataFrame, sketch: str) -> DataFrame:
        own = lambda side: classes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col(sketch).alias(f"s{side}"))
        return promising(pairs.join(own("a"), "a").join(own("b"), "b"))

    # Each set with its group's first set, and with the one before it.
    ends = shared.select(F.explode(F.array_distinct(F.array("first", "before"))).alias("first"), "h1").where("h1 <> first").distinct()
    one = known.select(F.col("h1").alias("first"), F.col("node").alias("a"), F.col("n").alias("na"))
    other = known.select("h1", F.col("node").alias("b"), F.col("n").alias("nb"))
    near = ends.join(one, "first").join(other, "h1").where("4 * least(na, nb) >= 3 * greatest(na, nb)").select("a", "b")
    stars = stored(tested(tested(near, "coarse"), "sketch"), "star-pairs")
    links = stored(verified(docs, classes, stars), "star-links")
    labels = stored(connected_components(links), "components")

    # Across the components of a group: all pairs of small groups and the nearest of large ones, then all pairs of these.
    def linked(held: DataFrame, nearest: bool) -> tuple[DataFrame, DataFrame]:
        """Links across components, and the members of the large groups that hold several: small ones are done after this, and components only grow."""
        members = held.join(labels.withColumnRenamed("component", "label"), "node", "left").select("signature", "node", "n", F.coalesce("label", "node").alias("component"))
        mixed = (
            members.groupBy("signature").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"),
                                             F.bit_xor(F.xxhash64("node")).alias("s1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2"))
            # Signatures with the same sets are one group.
            .where((F.col("lo") < F.col("hi")) & (F.col("size") > SETTLED)).groupBy("size", "s1", "s2").agg(F.min("signature").alias("signature"))
            .select("signature", "size", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
        )
        open_groups = stored(members.join(mixed, "signature"), "open-groups")
        dealt = open_groups.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        grouped = dealt.join(classes.select("node", "sketch"), "node").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
            .withColumn("i", F.least("block", "k")).withColumn("j", F.greatest("block", "k"))
        pairs = stored(across(grouped, nearest).distinct(), "cross-pairs")
        return stored(verified(docs, classes, pairs), "cross-links"), open_groups.where(F.col("size") > SMALL).select("signature", "node", "n")

    def merged(more: DataFrame) -> DataFrame:
        """Components of the links found so far and of `more`."""
        component = F.coalesce("component", F.col("x"))
        named = lambda side: more.select(F.col(side).alias("x"), "a", "b").join(labels, F.col("x") == F.col("node"), "left").select("a", "b", component.alias(f"c{side}"))
        joined = named("a").join(named("b"), ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        over = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("over"))
        old = labels.join(over, "component", "left").select("node", F.coalesce("over", "component").alias("component"))
        new = over.select(F.col("component").alias("node"), F.col("over").alias("component")).join(labels.select("node"), "node", "left_anti")
        return stored(old.unionByName(new), "components")

    held = shared.select("signature", "h1").join(known, "h1").select("signature", "node", "n")
    for nearest in (True,) * NEAREST_ROUNDS + (False,):  # the last round tests all pairs
        more, held = linked(held, nearest)
        if not more.isEmpty():
            labels = merged(more)
    ended = classes.select("h1", "h2", "node", "first_id").join(labels, "node", "left").select("h1", "h2", "first_id", F.coalesce("component", "node").alias("node"))
    ended = stored(ended, "class-components")
    final = ended.select("h1", "h2", "node").join(ended.groupBy("node").agg(F.min("first_id").alias("component")), "node").drop("node")
    return base.join(final, ["h1", "h2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), "doc_id")).alias("component_id"), "text_hash")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without all but one of each component, and without repeated rows of one id and text.

    Rows with a null id, and documents without words, stay.
    """
    linked = stored(link(docs), "linked").where("doc_id is not null").groupBy("doc_id", "text_hash").agg(
        F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    gone = linked.where("doc_id <> component_id").select("doc_id", "text_hash")
    repeated = linked.where("doc_id = component_id and n > 1").select("doc_id", "text_hash")
    one = picked(docs, repeated).dropDuplicates(["doc_id", "text"])
    return without(docs, gone.unionByName(repeated)).unionByName(one)
