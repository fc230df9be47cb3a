"""Personal data by anchor expansion: cues are found first, spans grow around them.

One Aho-Corasick automaton finds at-signs, plus signs, digits, URL schemes and
identifier cues in a single pass over the text. At each hit a local parser
expands to the span's two ends and validates it: mail addresses, IP addresses,
card and phone numbers by the base grammar; logins in URLs, IBANs, account
and social security numbers and secrets behind their cues. A parser reads only
the characters of its own span, so a text is read a bounded number of times.

Spans are in code points, the end exclusive. Per kind they are the leftmost
ones that don't overlap; a span that fails its validation is dropped and
nothing is tried in its place. Spans of different kinds may overlap. Cues are
found in either case and may end a longer word.

Defined results: null and empty texts have no spans. Whole texts are read, also
very long ones. Repeated rows are searched each on their own, null ids are
kept, and of the input's columns only doc_id and text are read, so other
columns can have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import as_bytes, per_batch

#: FIXED VALUES: kinds in the order in which spans are listed; the first four are the base.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "login", "iban", "account", "ssn", "secret"]

#: Cues of the kinds that stand behind one, in lower case.
CUES = {
    "login": ["://"],
    "iban": ["iban"],
    "account": ["account", "acct", "konto", "cuenta", "compte"],
    "ssn": ["ssn", "social security number"],
    "secret": ["token", "secret", "password", "passwd", "api_key", "apikey"],
}
#: What stands between a cue and its span, and the span.
BEHIND = {
    "login": r"()([A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%!$&*+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)",
    "iban": r"([ :=#]{0,3})([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)",
    "account": r"((?: (?:no|nr|number|id)\.?)?[ :=#]{0,3})([0-9](?:[ -]?[0-9])+)",
    "ssn": r"([ :=#]{0,3})([0-9]{3}-[0-9]{2}-[0-9]{4})",
    "secret": r"(\"? ?[:=] ?[\"']?)([A-Za-z0-9_/+.-]{12,})",
}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9](?:[ .-]?[0-9])*")
_FOUR = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_BEHIND = {kind: re.compile(rule) for kind, rule in BEHIND.items()}

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    from_right = [int(d) for d in reversed(digits)]
    return (sum(from_right[::2]) + sum(sum(divmod(2 * d, 10)) for d in from_right[1::2])) % 10 == 0


def iban_valid(iban: str) -> bool:
    """ISO 7064 mod 97 of an IBAN without spaces."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid(kind: str, value: str) -> bool:
    if kind == "ip":  # lengths first: a part may have very many digits
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in value.split("."))
    if kind == "card":
        digits = _only_digits(value)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_only_digits(value)) <= 15
    if kind == "iban":
        return 15 <= len(value.replace(" ", "")) <= 34 and iban_valid(value.replace(" ", ""))
    if kind == "account":
        return 6 <= len(_only_digits(value)) <= 18
    if kind == "ssn":
        area, group, serial = value.split("-")
        return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    return True


def automaton() -> ahocorasick.Automaton:
    """Cues, at-signs, plus signs and digits; a value is (kind, length), "number" for a digit."""
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("number", 1))
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for kind, cues in CUES.items():
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def spans_of(text: str, lower: str, anchors: ahocorasick.Automaton) -> list[Span]:
    """All valid spans of a text, sorted by kind and start. `lower` is the text with A-Z lower-cased."""
    spans: list[Span] = []
    done = dict.fromkeys([*KINDS, "number"], 0)  # where the last match of each kind ended
    sign = -1  # the last at-sign
    for last, (kind, length) in anchors.iter(lower):
        start = last + 1 - length
        if start < done[kind]:
            continue
        if kind == "number":
            run = _NUMBERS.match(text, start)
            done["number"] = run.end()
            if run.end() - start >= 7:
                for rule, name in ((_FOUR, "ip"), (_DIGITS, "card")):
                    spans += [(name, m.start(), m.end()) for m in rule.finditer(text, start, run.end()) if _valid(name, m.group())]
        elif kind == "email":
            left = text[max(done["email"], sign + 1):start]
            sign, local = start, len(left) - len(left.rstrip(_LOCAL))
            if local and (domain := _DOMAIN.match(text, start + 1)):
                done["email"] = domain.end()
                spans.append(("email", start - local, domain.end()))
        elif kind == "phone":
            if match := _PHONE.match(text, start):
                done["phone"] = match.end()
                if _valid("phone", match.group()):
                    spans.append(("phone", start, match.end()))
        elif match := _BEHIND[kind].match(text, last + 1):
            done[kind] = match.end()
            if _valid(kind, match.group(2)):
                spans.append((kind, match.start(2), match.end()))
    rank = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (rank[s[0]], s[1]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
SCHEMA = "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint, value: string>>"


def _searched(batch: pa.RecordBatch) -> Iterator[tuple[str, list[Span]]]:
    anchors = automaton()
    for raw in as_bytes(batch.column(1)):
        text = raw.decode("utf-8", "replace")
        # Lower-casing bytes changes ASCII letters alone, so places stay the same.
        yield text, spans_of(text, raw.lower().decode("utf-8", "replace"), anchors)


def find(docs: DataFrame) -> DataFrame:
    """doc_id and the text's spans of personal data (kind, start, end, value), by kind and start. Input: doc_id, text."""
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN))])

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[dict(kind=k, start=a, end=b, value=text[a:b]) for k, a, b in spans] for text, spans in _searched(batch)]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(rows, pa.list_(_SPAN))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(per_batch(of_batch), SCHEMA)


def redact(docs: DataFrame) -> DataFrame:
    """doc_id and the text with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for (text, spans), known in zip(_searched(batch), batch.column(1).is_valid().to_pylist()):
            parts, covered = [], 0
            for kind, start, end in sorted(spans, key=lambda s: s[1]):
                if start >= covered:
                    parts += [text[covered:start], f"<{kind}>"]
                covered = max(covered, end)
            texts.append("".join([*parts, text[covered:]]) if known else None)
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(per_batch(of_batch), "doc_id long, text string")


def written(spans: Column) -> Column:
    """`kind:start:end` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans, their SHA-256, and all spans as text."""
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(written(of(BASE_KINDS)), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
