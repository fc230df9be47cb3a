import regex

from martspark.llm import license_scan as L

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_exact_places_and_fuzzy_notices_against_brute_force(spark, words):
    texts = [
        "Released under the MIT License.", "released undr the mit licence", "The MIT\nLicense MIT license mit license",
        "Licensed under the Apache Licence, Version 2.0", "under the GNU General Public License, version 3.", "general public licenses",
        "Licensed under CC BY-NC 4.0.", "licensed under cc by sa 4 0", "released under the bsd license", "mitt license", None, "",
        words(300) + " Released  under\tthe MIT License. " + words(50), "É mit license É",
    ] + [words(40) for _ in range(20)]
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        own = words_of(text)
        assert got[i].n_words == len(own)
        places = sorted((label, at) for phrase, label in L.PHRASES.items() for at in range(len(own)) if own[at:at + len(phrase.split())] == phrase.split())
        assert sorted((m.label, m.start_word) for m in got[i].phrases) == places
        flat = " ".join(own)
        for notice in L.NOTICES:  # the library's own search over the whole text
            whole = regex.search(f"(?:{regex.escape(notice.text)}){{e<={notice.edits}}}", flat)
            assert bool(whole) == any(m.label == notice.label and m.similarity >= 1 - notice.edits / len(notice.text) for m in got[i].notices) or \
                any(n.label == notice.label and n is not notice for n in L.NOTICES)
    one = got[1].notices[0]
    assert (one.label, one.edits, one.start_word, one.end_word) == ("mit", 2, 0, 5)
    assert {m.label for m in got[6].notices} == {"cc-by-nc"} and not got[7].notices and not got[8].notices and not got[9].phrases
    assert got[12].notices[0].start_word == 300


def test_edges(edge_documents, empty_documents):
    rows = L.scan(edge_documents).collect()
    assert len(rows) == 12 and sum(r.n_words for r in rows if r.doc_id in (1, 2, 6)) == 0
    assert L.scan(empty_documents).count() == 0


def test_pieces_cover_the_notice():
    for notice in L.NOTICES:
        parts = L.pieces(notice)
        assert len(parts) == notice.edits + 1 and "".join(p for _, p in parts) == notice.text
