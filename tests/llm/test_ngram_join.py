import random

import numpy as np
import pytest

from martspark.llm import common as C
from martspark.llm import ngram_join as J
from martspark.llm.components import connected_components


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    """Component by comparing all pairs."""
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(words, seed, n=260):
    """Copies, near copies over and under the threshold, chains, a passage that most share, short texts."""
    pick, texts = random.Random(seed), []
    passage, line = words(45), words(9)
    while len(texts) < n:
        base = words(pick.choice([1, 3, 5, 6, 8, 12, 20, 33, 40, 64, 90, 150, 300])).split()
        if pick.random() < 0.5:
            base[len(base) // 2:len(base) // 2] = (passage if pick.random() < 0.6 else line).split()
        for _ in range(pick.choice([1, 1, 2, 3, 8])):
            texts.append(" ".join(base))
            for _ in range(pick.choice([0, 0, 1, 1, 2, 3])):  # drifts: chains of near copies
                base[pick.randrange(len(base))] = words(1)
            if pick.random() < 0.2:
                base = base + words(pick.randint(1, 1 + len(base) // 4)).split()
    pick.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize(("seed", "common", "block", "small"), [(1, 8, 2048, 24), (2, 3, 16, 3), (3, 10**9, 2048, 2)])
def test_components_match_all_pairs(spark, words, monkeypatch, seed, common, block, small):
    """Whatever counts as common, and however groups are cut into blocks."""
    monkeypatch.setattr(J, "COMMON_IN_TASK", common)
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "SMALL", small)
    texts = corpus(words, seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link(docs).collect()}
    assert got == brute(texts)


def test_word_hashes_tell_words_apart(monkeypatch):
    """Equal words have equal hashes wherever they stand, different ones differ; counts are those of the split."""
    pick = random.Random(5)
    stock = ["a", "b", "ab", "ba", "A", "\u00e9t\u00e9", "\u4f60\u597d", "x\0", "x", "eightchr", "eightchrs", "sixteencharacter", "sixteencharacters",
             "p" * 1024, "p" * 1025, "p" * 5000, "q" * 5000, "\x1c", "\x85", "\u00a0"]
    texts = ["", " ", "\t\n\x0b\x0c\r "] + ["".join(pick.choice(stock) + pick.choice([" ", "  ", "\n", "\x0b"]) for _ in range(pick.randrange(30))) for _ in range(200)]
    raw = [t.encode() for t in texts]
    for held in (1 << 20, 50):
        monkeypatch.setattr(C, "HASHED_TEXT", held)
        hashes, counts = C.word_hashes(raw)
        words = [w for t in raw for w in C.space_words(t)]
        assert counts.tolist() == [len(C.space_words(t)) for t in raw]
        assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    assert [len(x) for x in C.word_hashes([])] == [0, 0]


def test_similar_sets_always_share_a_signature():
    """Random pairs at and above the threshold, with and without common features."""
    pick = np.random.default_rng(4)
    tried = 0
    for _ in range(3000):
        n = int(pick.integers(3, 140))
        a = np.sort(pick.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        gone, new = pick.integers(0, n // 6 + 1), pick.integers(0, n // 5 + 1)
        b = np.sort(np.concatenate([pick.permutation(a)[gone:], pick.integers(0, 2**63, new, dtype=np.int64).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 75 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        tried += 1
        hot = np.unique(pick.permutation(a)[: pick.integers(0, n + 1)])
        for common in ((np.zeros(0, np.uint64), np.zeros(0, np.int64)), (hot, pick.permutation(len(hot)))):
            sign, doc = J.signatures(np.concatenate([a, b]), np.array([len(a), len(a) + len(b)]), common)
            assert set(sign[doc == 0]) & set(sign[doc == 1])
        assert len(a) + len(b) - 2 * both <= (len(a) + len(b)) / 7
        for cut in (lambda x: x, J.coarse):
            assert J.within([cut(J.odd_sketch(a))], [cut(J.odd_sketch(b))], np.array([len(a) + len(b)])).all()
    assert tried > 1000


def test_edges(edge_documents, empty_documents):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.link(edge_documents).collect()), key=str)
    n = 30_000 - 4 - sum(0 for _ in ())
    by = {i: (k, c) for i, k, c in got if i is not None}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[6] == (0, 6)
    assert by[3] == (1, 3) and by[8] == (1, 3) and by[9] == (2, 9) and by[10] == (2, 9)
    assert by[4][0] <= n and by[4][1] == by[5][1] == 4
    assert sum(i is None and c is None for i, _, c in got) == 1 and len(got) == 12
    assert J.link(empty_documents).count() == 0
    kept = J.one_of_each(edge_documents)
    assert kept.schema == edge_documents.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 9]


def test_one_id_with_two_texts_that_both_have_near_copies(spark, words):
    one, two = words(60), words(60)
    rows = [(1, one), (1, two), (2, one + " end"), (3, two + " end"), (4, words(60)), (5, one), (6, two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.link(docs).collect())
    assert got == [(1, 56, 1), (1, 56, 1), (2, 57, 1), (3, 57, 1), (4, 56, 4), (5, 56, 1), (6, 56, 1)]
    assert sorted((r.doc_id, r.text) for r in J.one_of_each(docs).collect()) == sorted([rows[0], rows[1], rows[4]])


def test_connected_components(spark):
    pick = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 60)] + [(200, i) for i in range(201, 400)] + [(pick.randint(500, 700), pick.randint(500, 700)) for _ in range(90)]
    root = {n: n for e in edges for n in e}
    for _ in range(len(root)):
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in root.items() if n in got} and all(root[n] == n for n in set(root) - set(got))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_counted_keeps_what_stands_twice():
    pick = np.random.default_rng(5)
    old, all_of, kept = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), {}, {}
    for _ in range(6):
        fresh = pick.integers(0, 60, 40).astype(np.uint64)
        old = J.counted(old, fresh)
        for v, n in zip(*np.unique(fresh, return_counts=True)):
            if v in kept or n >= 2:
                kept[v] = kept.get(v, 0) + n
        assert dict(zip(*old)) == kept and (np.diff(old[0].astype(np.int64)) > 0).all()


def test_features_are_common_by_all_tasks(spark, words):
    """Two in each of six tasks are twelve."""
    passage = words(9)
    docs = spark.range(0, 12, 1, 6).selectExpr("id doc_id", f"concat('{passage} a', id, ' b', id, ' c', id) text")
    assert sorted(J.common_features(J.describe(docs))) == sorted(J.shingle_sets([passage.encode()])[0].view(np.int64).tolist())
    few = docs.where("doc_id < 6")  # six documents with it
    assert J.common_features(J.describe(few)) == []


def test_small_groups_are_open_in_one_round(spark, words, monkeypatch):
    """Six sets with a passage in common, none linked; and groups of three, settled by the first pairs."""
    passage, other, opened = words(30), words(30), []
    stored = J.stored

    def watched(df, name):
        out = stored(df, name)
        if name == "open-groups":
            opened.append(out.groupBy("signature").count().collect())
        return out

    monkeypatch.setattr(J, "stored", watched)
    texts = [f"{passage} {words(40)}" for _ in range(6)] + [f"{other} {words(40)}" for _ in range(3)]
    got = J.link(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(dict(enumerate(texts)))
    assert len(opened) == J.NEAREST_ROUNDS + 1
    assert opened[0] and {r["count"] for r in opened[0]} <= {4, 5, 6} and opened[1:] == [[], []]
