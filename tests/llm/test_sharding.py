import hashlib
from collections import defaultdict

from martspark.llm import sharding as S


def prefix_tree(rows, limit):
    """Extendible hashing by hand: split a bucket while it is over the limit and holds two rows."""
    out = {}

    def split(prefix, members):
        if sum(b for _, b, _ in members) <= limit or len(members) == 1:
            out.update({i: prefix for i, _, _ in members})
            return
        for bit in "01":
            part = [m for m in members if m[2].startswith(prefix + bit)]
            if part:
                split(prefix + bit, part)
    split("", rows)
    return out


def test_matches_a_tree_built_by_hand(spark, words):
    texts = {i: words(1 + i % 60) for i in range(400)}
    bits = {i: bin(int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16))[2:].zfill(48) for i in texts}
    for limit in (300, 2000, 10**9):
        got = S.assign(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), limit).collect()
        expected = prefix_tree([(i, len(t.encode()), bits[i]) for i, t in texts.items()], limit)
        assert {r.doc_id: r.shard for r in got} == expected
        sums = defaultdict(int)
        for r in got:
            sums[r.shard] += r.bytes
            assert r.depth == len(r.shard)
        assert all(sums[r.shard] == r.shard_bytes and (r.shard_bytes <= limit or r.shard_docs == 1) for r in got)


def test_a_hot_id_is_split_too(spark):
    rows = [(7, "same text of one id")] * 300 + [(i, "other text") for i in range(100)]
    got = S.assign(spark.createDataFrame(rows, "doc_id long, text string"), 500).collect()
    assert len(got) == 400 and all(r.shard_bytes <= 500 for r in got)
    assert len({r.shard for r in got if r.doc_id == 7}) >= 300 * 19 // 500


def test_repeated_ids_are_written_once_each(spark, tmp_path):
    rows = [(7, f"text {i:03}") for i in range(60)] + [(None, "no id")] * 3 + [(i, "other") for i in range(20, 30)]
    S.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), 100, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t) for i, t in rows)
    held = defaultdict(int)
    for r in back:
        held[r.shard] += len(r.text)
    assert max(held.values()) <= 100


def test_edges_and_files(spark, edge_documents, empty_documents, tmp_path):
    got = S.assign(edge_documents, 100).collect()
    assert len(got) == 12 and all(r.shard_bytes <= 100 or r.shard_docs == 1 for r in got)
    assert S.assign(empty_documents, 100).count() == 0
    docs = spark.createDataFrame([(i, "text " * i) for i in range(50)], "doc_id long, text string")
    S.write_shards(docs, 1000, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(50)) and back.select("shard").distinct().count() > 5


def test_documents_with_a_column_shard(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * 20, i) for i in range(50)], "doc_id long, text string, shard long")
    S.write_shards(docs, 1000, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and "shard_" in back.columns and back.where("shard = doc_id").count() == 50
