import hashlib
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from martspark.llm import alignment as A
from martspark.llm.packing import tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def letters():
    """The byte-level alphabet as its authors give it."""
    seen = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    rest = [b for b in range(256) if b not in seen]
    return dict(zip(map(chr, seen + [256 + i for i in range(len(rest))]), seen + rest))


@pytest.fixture(scope="module")
def encoders():
    a, b, byte = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1]), letters()
    a.encode_special_tokens = True

    def piece(i):
        p = b.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode()

    def tokens(text):
        whole = b" " + (text or "").encode()
        ta = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + (text or ""), add_special_tokens=False).ids]
        tb = [(i, piece(i)) for i in b.encode(text or "")]
        return (ta, tb) if text and b"".join(x for _, x in ta) == whole == b"".join(x for _, x in tb) else ([], [])
    return tokens


def spread(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(texts, encoders):
    """Groups by common ends, links by comparing every A with every B token."""
    each, counts = [], Counter()
    for text in texts:
        a, b = map(spread, encoders(text))
        links = [(i, k) for i, s, e in a for k, t, f in b if s < f and t < e]
        groups, x, y = [], 0, 0
        for cut in sorted({e for _, _, e in a} & {e for _, _, e in b}):
            u, v = [i for i, _, e in a if x < e <= cut], [i for i, _, e in b if y < e <= cut]
            groups.append(",".join(map(str, u)) + "|" + ",".join(map(str, v)))
            x = y = cut
        counts.update(links)
        each.append((len(a), len(b), groups, links))
    most = {}
    for (_, k), n in counts.items():
        most[k] = max(n, most.get(k, 0))
    return [(na, nb, len(g), len(ln), sum(counts[p] == most[p[1]] for p in ln), sum(counts[p] for p in ln), ";".join(g)) for na, nb, g, ln in each]


def rows_of(texts, encoders):
    return [(i, *x[:-1], hashlib.sha256(x[-1].encode()).hexdigest() if x[-1] else "") for i, x in enumerate(brute(texts, encoders))]


TEXTS = [
    None, "", " ", "  two  spaces ", "word", "word", "naïve café, déjà-vu", "漢字とかな 🎉🎉 emoji", "a▁b holds the mark", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "tab\tand\nline\r\n", "x" * 3000, "ﬁ ligature ①②", "\u0000nul", "don't we'll I'd", "éé" * 500, "1234567890 3.14159",
]


def test_summary_against_brute_force(spark, encoders, words, monkeypatch):
    texts = TEXTS + [words(60) for _ in range(40)]
    expected = rows_of(texts, encoders)
    assert sum(r[1] > 0 for r in expected) > 40 and expected[8][1:5] == (0, 0, 0, 0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, A.summary(docs, *PATHS).collect())) == expected
    got = {r.doc_id: r for r in A.groups(docs, *PATHS).collect()}
    assert [got[i].groups for i in range(len(texts))] == [x[-1] for x in brute(texts, encoders)]


def test_blocks_of_any_size_give_the_same(spark, encoders, words, monkeypatch):
    texts = [words(50) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    tokens = A.Tokens(*PATHS)
    whole = A.align(tokens, [t.encode() for t in texts])
    apart = [A.align(tokens, [t.encode()]) for t in texts]
    assert whole.groups == [x.groups[0] for x in apart] and whole.pairs.tolist() == np.concatenate([x.pairs for x in apart]).tolist()
    assert whole.n_groups.tolist() == [x.n_groups[0] for x in apart]
    assert A.blocks(docs, *PATHS).where("place is null").count() == 30


def test_coalesce_and_overlaps():
    starts, ends = np.array([0, 2, 5, 0, 3, 5]), np.array([2, 5, 6, 3, 5, 6])
    assert A.coalesce(starts, ends).tolist() == [0, 0, 1, 0, 0, 1]
    count, other = A.overlaps(starts[:3], ends[:3], starts[3:], ends[3:])
    assert count.tolist() == [1, 2, 1] and other.tolist() == [0, 0, 1, 2]
    assert A.from_planes(A.planes(np.array([0, 0, 3, 70000, 70000]))).tolist() == [0, 0, 3, 70000, 70000] and A.from_planes(b"").tolist() == []


def test_edges(spark, edge_documents, empty_documents, encoders):
    rows = edge_documents.select("doc_id", "text").collect()
    expected = brute([r.text for r in rows if len(r.text or "") < 1000], encoders)
    got = A.summary(edge_documents, *PATHS).collect()
    assert len(got) == 12 and sum(r.doc_id is None for r in got) == 1
    assert sum(r.n_a == 0 for r in got) == sum(x[0] == 0 for x in expected) == 2
    assert len({r.groups_sha256 for r in got if r.doc_id in (3, 8)}) == 1
    long = {r.doc_id: r for r in got}
    assert long[5].n_links > long[4].n_links > 100_000 and all(r.n_links == r.n_a + r.n_b - r.n_groups for r in got)
    assert A.summary(empty_documents, *PATHS).count() == 0 and A.groups(empty_documents, *PATHS).count() == 0


def test_a_word_is_encoded_once_for_the_slices_of_a_task(encoders, words, monkeypatch):
    texts = [t or "" for t in TEXTS] + [words(40) for _ in range(20)]
    expected = brute(texts, encoders)
    tokens, encoded = A.Tokens(*PATHS), []
    lines = tokens.lines
    monkeypatch.setattr(tokens, "lines", lambda x: encoded.extend(x) or lines(x))

    def rows(some):
        x = A.align(tokens, [t.encode() for t in some])
        return list(zip(x.n_a.tolist(), x.n_b.tolist(), x.n_groups.tolist(), x.n_links.tolist(), [g.decode() for g in x.groups]))

    short = [(*x[:4], x[-1]) for x in expected]
    assert rows(texts) == short and encoded
    encoded.clear()
    assert rows(texts[::-1]) == short[::-1] and not encoded
    monkeypatch.setattr(A, "HELD_WORDS", 3)  # starts anew after every slice
    assert [rows([t])[0] for t in texts] == short and encoded and len(tokens.place) <= 3
