import hashlib
import random
import re

import pytest

from martspark.llm import personal_data as P

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, digits[::-1])):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def fits(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    return [(k, m.start(), m.end()) for k, rule in BASE.items() for m in re.finditer(rule, text or "") if fits(k, m.group())]


def behind(text):
    """Spans behind cues by one search of cue and rule over the text."""
    found = []
    for kind in P.KINDS[4:]:
        cues = "|".join(map(re.escape, P.CUES[kind]))
        for m in re.finditer(f"(?ai:{cues}){P.BEHIND[kind]}", text or ""):
            if P._valid(kind, m.group(2)):
                found.append((kind, m.start(2), m.end()))
    return found


TEXTS = [
    None, "", "no data here", "mail a.b+c@mail.example.com, x@y and @home.org or z@w..de a@b@c.de",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 and 0001.02.3.255 1..2.3.4.5", "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111",
    "+1 (663) 555-6869, +12, +1 2, +49 30 1234567-, ++1 5555555555 +1..9999999999..", "é漢 ann@example.com 🎉 10.0.0.1",
    "http://joe:pa55@host.example.com/x ftp://u@h", "IBAN: DE89 3704 0044 0532 0130 00 and iban DE00370400440532013000",
    "Account no. 12345678, acct#99-88-77 account 12", "SSN 123-45-6789 ssn: 666-12-1234 Social Security Number 001-01-0001",
    'token = "7c72db563d7f6e50cec00950f7bab1f2" password: short secret=abcdefghijklmnop token=a_token:bcdefghijklmnop', "İİ SSN 123-45-6789 İ token: abcdefghijklmnop",
    "9" * 5000, "a@" * 3000 + "b.de", "1." * 3000, "+" * 50 + "1 " * 40,
]


def found(text):
    raw = (text or "").encode()
    return P.spans_of(text or "", raw.lower().decode(), P.automaton())


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_each_text_against_the_rules(text):
    assert found(text) == brute(text) + behind(text)


def test_random_texts_against_the_rules():
    pick = random.Random(3)
    parts = ["@", ".", "+", "-", " ", "1", "23", "456", "4111111111111111", "a", "Bc", "iban", "SSN", "token", "=", ":", "://", "(", ")", "é", "account", "é@", "123-45-6789", "abcdefghijklmn"]
    for _ in range(20_000):
        text = "".join(pick.choices(parts, k=pick.randint(1, 25)))
        assert found(text) == brute(text) + behind(text), text


def test_digest(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in P.digest(P.find(docs)).collect()}
    for i, text in enumerate(TEXTS):
        base, more = brute(text), behind(text)
        assert [rows[i][f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in base) for k in BASE]
        line = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert rows[i].base_sha256 == hashlib.sha256(line(base).encode()).hexdigest() and rows[i].spans == line(base + more)
    assert rows[9].spans.startswith("iban:6:33") and "login" in rows[8].spans and rows[11].spans.count("ssn") == 2
    values = {r.doc_id: r.spans for r in P.find(docs).collect()}
    assert [s.value for s in values[3]] == ["a.b+c@mail.example.com", "b@c.de"]


def test_redact(spark):
    docs = spark.createDataFrame([(1, "to ann@example.com from 10.0.0.1!"), (2, "+1 (663) 555-6869"), (3, None), (4, "http://joe:pa55@host.example.com/")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in P.redact(docs).collect()} == {1: "to <email> from <ip>!", 2: "<phone>", 3: None, 4: "http://<login>/"}


def test_edges(edge_documents, empty_documents):
    rows = P.digest(P.find(edge_documents)).collect()
    assert len(rows) == 12 and all(r.n_email == r.n_ip == r.n_card == r.n_phone == 0 and r.spans == "" for r in rows)
    assert P.find(empty_documents).count() == P.redact(empty_documents).count() == 0
