import random
import re
from itertools import permutations

import numpy as np

from martspark.llm import filter_audit as F


def failing(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    text = text or ""
    tests = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)), copy]
    return {c for c, bad in zip("ABCDE", tests) if bad}


def brute(rows, labels):
    """Every document followed through every order. rows: (doc_id, text, lang)."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    docs = []
    for i, text, lang in rows:
        copy = i is not None and any(j is not None and j < i and (other or "") == (text or "") for j, other, _ in rows)
        docs.append((lang or "", i, failing(text, copy)))
    out = []
    for part in {d[0] for d in docs}:
        own, share, lines = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[2]]
                before = sum(c in d[2] for d in own) - len(gone)
                left = [d for d in left if c not in d[2]]
                share[c] += len(gone)
                lines.append((part, order, step, len(left), len(gone), before, sum(d[2] == {c} for d in own), sum(d[1] in good for d in gone if d[1] is not None),
                              sum(d[1] in toxic for d in gone if d[1] is not None)))
        out += [(*line, share[line[1][line[2] - 1]]) for line in lines]
    return sorted(out)


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 part", "2 fails", "3 digest", "4 good", "5 n", "6 toxic", "7 first")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' lang", "1 n", "2 part")


def test_audit_against_brute_force(spark, words):
    pick = random.Random(11)
    pool = [None, "", " \t", "A" * 40, words(120), words(150) + " & more", words(20), "One two # three", " ".join(["same"] * 130), "É" * 9 + "A", words(110).upper(), " ".join(["a b"] * 70)]
    rows = [(i, pick.choice(pool), pick.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [(7, pool[4], "en"), (7, pool[4], "en"), (None, pool[4], "de"), (None, None, None), (3, "fresh text", "fr"), (200, "fresh text", "fr")]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    docs, known = frames(spark, rows, labels)
    got = sorted(tuple(r) for r in F.audit(docs, known).collect())
    assert got == brute(rows, labels) and len(got) == 4 * 600


def test_edges(spark, edge_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.lang) for r in edge_documents.collect()]
    assert sorted(tuple(r) for r in F.audit(edge_documents, labels).collect()) == brute(rows, [])
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert F.audit(none, labels).count() == 0


def test_min_plus_product():
    masks = np.array([[False, False, False], [True, False, True], [False, True, False]])
    places = np.array([[0, 1, 2], [2, 0, 1]])
    assert F.removal_steps(masks, places).tolist() == [[np.inf, np.inf], [0, 1], [1, 0]]


def test_one_id_or_text_in_many_rows_does_not_widen_the_counts(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) doc_id", "if(id % 2 = 0, 'often', concat('text ', id)) text", "'en' lang")
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    counts = F.mask_counts(rows, labels).collect()
    assert sum(r.n for r in counts) == 3000 and sum(r.n_good for r in counts) == 1001 and len(counts) <= 4
    local = rows.toPandas()
    least = local.groupby("text").doc_id.min()
    assert sum(r.n for r in counts if r.fails >= 16) == int((local.doc_id > local.text.map(least)).sum())
