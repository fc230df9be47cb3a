import hashlib
import random
import re

from pyspark.sql import functions as F

from martspark.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    grams = {}
    for item_id, text in items:
        w = words_of(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w and item_id is not None else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(str(item_id))
    sizes, out = {len(g) for g in grams}, []
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[tuple(w[i:i + n])]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def result(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 pos", "'x' term", "2 n_words", "3 diagonal")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 words", "2 item")
    return sorted((tuple(r)[:6] for r in D.digest(D.find(d, i)).collect()), key=str)


def test_against_brute_force(spark, words):
    pick = random.Random(8)
    items = [(i, words(pick.choice([12, 25, 40]))) for i in range(30)]
    items += [(100, "short item here"), (101, "xylophon"), (102, None), (103, ""), (None, words(20)), (30, items[3][1]), (104, "the the the the the the the the the the the the"), (105, "ÀB ΑΣ'Β e, c d e f g h i j k"), (3, words(15))]
    docs = []
    for i in range(150):
        text = words(pick.choice([5, 30, 120])).split()
        for _ in range(pick.randint(0, 2)):
            w = words_of(pick.choice(items)[1])
            a = pick.randint(0, max(0, len(w) - 9))
            text[pick.randint(0, len(text)):0] = w[a:a + pick.randint(8, 30)]
        sep = pick.choice([" ", ", ", "\n", "--"])
        docs.append((i, pick.choice(["", ". "]) + sep.join(x.upper() if x.isascii() and pick.random() < 0.1 else x for x in text) + pick.choice(["", "!"])))
    docs += [(500, None), (501, ""), (502, "!?"), (503, "a the the the the the the the the the the the the the b"), (503, "other text, same id: short item here"), (504, "(Short ITEM here)"), (504, "(Short ITEM here)"), (None, items[0][1]), (505, "ÀB ΑΣ Β e c d e f g h i j k"), (506, "àb ας β e c d e f g h i j k"), (507, "xylophon")]
    assert result(spark, docs, items) == brute(docs, items)


def test_edges(spark, edge_documents, empty_documents):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, "word")], "item_id long, text string")
    hit = {r.doc_id for r in D.find(edge_documents, items).where("n_hit > 0").collect()}
    assert hit == {3, 8, 9, 10}
    kept = D.clean(edge_documents, items)
    assert kept.schema == edge_documents.schema and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 5, 6, 7]
    assert D.find(empty_documents, items).count() == 0
    assert D.find(edge_documents, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_proximity_counts_items_whose_rarest_terms_stand_near(spark, words):
    items = spark.createDataFrame([(1, "alphaterm bb cc betaterm dd")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alphaterm bb cc xx betaterm dd"), (2, "alphaterm " + words(40) + " betaterm"), (3, "bb cc dd bb cc dd bb cc dd")], "doc_id long, text string")
    assert {r.doc_id: (r.n_near, r.n_hit) for r in D.find(docs, items, slop=3).collect()} == {1: (1, 0), 2: (0, 0), 3: (0, 0)}


def near_items(docs, items, slop=5, window=10):
    """By brute force: of each document row, the items of which a window's two rarest terms stand near their distance."""
    texts = [[w.lower() for w in words_of(t)] for _, t in docs]
    count = {}
    for w in (w for t in texts for w in t):
        count[w] = count.get(w, 0) + 1
    out = []
    for text in texts:
        at = {}
        for i, w in enumerate(text):
            at.setdefault(w, []).append(i)
        found = set()
        for item_id, t in items:
            w = [x.lower() for x in words_of(t)] if item_id is not None else []
            for s in range(max(0, len(w) - window) + 1 if w else 0):
                rare = sorted((count.get(x, 0), x, j) for j, x in enumerate(w) if s <= j < s + window)
                if rare[0][0] == 0:
                    continue
                (_, a, i), (_, b, j) = rare[0], rare[min(1, len(rare) - 1)]
                if any(abs((q - j) - (p - i)) <= slop for p in at.get(a, []) for q in at.get(b, [])):
                    found.add(str(item_id))
        out.append(len(found))
    return out


def test_proximity_against_brute_force(spark):
    pick = random.Random(18)
    some = lambda n: " ".join(pick.choice("abcdefghijklmnopqrstuvwxyz") * pick.choice([1, 2, 5]) for _ in range(n))
    items = [(i, some(pick.choice([1, 2, 6, 11, 14]))) for i in range(25)] + [(None, "a b"), (99, "a a"), (98, None)]
    docs = [(i, some(pick.choice([0, 3, 20, 60]))) for i in range(80)] + [(200, None), (201, "-- a, B")]
    got = D.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r.n_near for r in got} == dict(zip((d for d, _ in docs), near_items(docs, items)))


def test_long_text_of_two_words(spark):
    """Rows in proportion to the text: places meet near each other only."""
    n = 20_000
    docs = spark.createDataFrame([(1, "aa bb " * (n // 2))], "doc_id long, text string")
    items = spark.createDataFrame([(1, "aa bb " * 10)], "item_id long, text string")
    got = D.find(docs, items).first()
    assert (got.n_words, got.n_hit, got.item_ids, got.n_near) == (n, n, ["1"], 1)


def test_no_python_in_the_plans(spark, edge_documents, capsys):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    D.find(edge_documents, items).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)
