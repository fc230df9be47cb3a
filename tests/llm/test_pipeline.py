import random

import corpus_pipeline as C
from test_ngram_join import brute as near_duplicates
from test_decontaminate import brute as contamination


def test_stages_against_brute_force(spark, words, tmp_path, edge_documents, empty_documents):
    pick = random.Random(11)
    items = [(i, words(30)) for i in range(5)]
    texts = {i: words(pick.choice([30, 80])) for i in range(120)}
    toxic = {i for i in texts if i % 6 == 0}
    for i in toxic:
        texts[i] += " vileword uglyword"
    for i in range(1, 120, 9):
        texts[i] = words(5) + " " + items[i % 5][1][:200] + " " + words(5)
    for i in range(80, 100):
        texts[i + 100] = texts[i] + (" more words" if i % 2 else "")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i in toxic)) for i in range(120)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = dict(texts)
    for name, stage in C.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang"]
        if name == "toxicity":
            left = {i: t for i, t in left.items() if "vileword" not in t}
        elif name == "near_duplicates":
            groups = near_duplicates(left)
            left = {i: t for i, t in left.items() if groups[i][1] == i}
        else:
            left = {r[0]: left[r[0]] for r in contamination(list(left.items()), items) if not r[5]}
        assert {r.doc_id: r.text for r in docs.collect()} == left
    assert {r.doc_id for r in C.run(spark, str(tmp_path)).collect()} == set(left)
    for _, stage in C.STAGES:
        assert stage(spark, empty_documents, str(tmp_path)).count() == 0
        stage(spark, edge_documents, str(tmp_path)).collect()
