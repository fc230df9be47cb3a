import random

import numpy as np

from martspark.llm import toxicity as T


def corpus(words, n, seed):
    pick, out = random.Random(seed), []
    for i in range(n):
        text, toxic = words(pick.randint(20, 200)).split(), i % 5 == 0
        if toxic:
            for _ in range(pick.randint(2, 8)):
                text.insert(pick.randrange(len(text)), pick.choice(["vileword", "Badword", "uglyword"]))
        out.append((i, " ".join(text), int(toxic)))
    return out


def test_held_out_accuracy(spark, words):
    rows = corpus(words, 900, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y if i % 17 else 1 - y) for i, _, y in rows if i < 500], "doc_id long, toxic int")  # some labels are wrong
    got = {r.doc_id: r for r in T.grade_documents(docs, labels).collect()}
    held = [(y, got[i].toxic) for i, _, y in rows if i >= 500]
    assert sum(bool(y) == p for y, p in held) / len(held) > 0.97
    kept = {r.doc_id for r in T.keep_clean(docs, labels).collect()}
    assert kept == {i for i in got if not got[i].toxic}
    assert all(0 <= r.expected_severity <= 3 for r in got.values())


def test_a_rare_toxic_lexicon_counts_beside_a_frequent_one(spark, words):
    pick, rows = random.Random(4), []
    lexicons = {"frequent": ["vileword", "badword", "uglyword"], "rare": ["böswort", "übelwort", "fieswort"]}
    for i in range(2000):
        text, kind = words(pick.randint(20, 200)).split(), "frequent" if i % 5 == 0 else "rare" if i % 50 == 1 else "clean"
        for word in lexicons.get(kind, []):
            text.insert(pick.randrange(len(text)), word)
        rows.append((i, " ".join(text), kind))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k != "clean")) for i, _, k in rows if i < 1000], "doc_id long, toxic int")
    rejected = {r.doc_id for r in T.grade_documents(docs, labels).collect() if r.toxic}
    held = {kind: {i for i, _, k in rows if i >= 1000 and k == kind} for kind in ("frequent", "rare", "clean")}
    assert len(held["rare"]) == 20 and held["rare"] <= rejected and held["frequent"] <= rejected
    assert len(rejected & held["clean"]) <= 0.01 * len(held["clean"])


def test_a_repeated_id_gives_the_fit_one_row(spark, words, monkeypatch):
    seen, fit_ordinal = [], T.fit_ordinal
    monkeypatch.setattr(T, "fit_ordinal", lambda row, col, value, grade, *a: seen.append(grade) or fit_ordinal(row, col, value, grade, *a))
    rows = corpus(words, 200, 3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    copies = [(5, rows[5][1])] * 300 + [(6, words(30)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + copies, "doc_id long, text string")
    model = T.fit(docs.repartition(4), labels)
    assert len(seen[0]) == 200 and sum(seen[0] > 0) == 40
    assert T.grade(docs, model).count() == 800


def test_fit_orders_thresholds_and_shares_weights():
    pick = np.random.default_rng(3)
    x = pick.random((2000, 3))
    score = x @ np.array([6.0, -4.0, 0.0]) + pick.logistic(size=2000)
    grade = np.digitize(score, [0.0, 2.0, 4.0])
    row, col = np.nonzero(x)
    w, t = T.fit_ordinal(row, col, x[row, col], grade, 3, 4)
    assert np.allclose(w, [6, -4, 0], atol=0.8) and np.allclose(t, [0, 2, 4], atol=0.6) and (np.diff(t) > 0).all()


def test_edges(spark, edge_documents, empty_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (9, 1), (9, 0)], "doc_id long, toxic int")
    assert T.grade_documents(edge_documents, labels).count() == 12
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = T.grade_documents(edge_documents, none).collect()
    assert len(rows) == 12 and not any(r.toxic for r in rows)
    assert T.keep_clean(edge_documents, none).schema == edge_documents.schema
    assert T.grade_documents(empty_documents, labels).count() == 0
