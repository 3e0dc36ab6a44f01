"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Four plain kinds are found wherever their rule holds: email, ip, card (16 to 19 digits passing Luhn) and
phone (with a plus sign). Further kinds start from a score of their pattern, which words within
``NEAR`` code points raise or lower; they count from ``LEAST`` on: iban (mod-97 must be 1), ssn,
short_card (13 to 15 digits passing Luhn) and local_phone. A further span that touches a plain
one, or stands next to a letter or digit, is dropped.

Spans are (kind, start, end, score) in code points, end exclusive, ordered by kind, then start. Null and empty
texts have none; texts of any length are read whole in linear time; repeated rows are read alike. An
empty table gives an empty table. An input column that has the name of the output column is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order of the output, their scores without context, words by kind.
PLAIN = ("email", "ip", "card", "phone")
FURTHER = ("iban", "ssn", "short_card", "local_phone")
SCORES = {
    "email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7,
    "iban": 0.8, "ssn": 0.4, "short_card": 0.4, "local_phone": 0.4,
}
WORDS = {
    "email": "email|mail|contact|write", "ip": "ip|address|host|server", "card": "card|visa|credit|debit|karte|tarjeta|carte",
    "phone": "phone|tel|call|fax|mobile", "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social|security", "short_card": "card|visa|amex|credit|debit|karte|tarjeta|carte",
    "local_phone": "phone|tel|call|fax|mobile",
}
UNLIKELY = "order|invoice|version|isbn|serial|build|part|ticket"
#: Change of the score by a word for the kind and by a word against it, code points around the span, least score.
RAISE, LOWER, NEAR, LEAST = 0.3, 0.3, 40, 0.6

LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its first digit only: from within it the rest is the same.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_LOCAL_PHONE = re.compile(r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}")
_NO_DIGIT = re.compile(r"[^0-9]+")
_FOR = {kind: re.compile(rf"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)") for kind, words in WORDS.items()}
_AGAINST = re.compile(rf"(?:^|[^a-z])(?:{UNLIKELY})(?:[^a-z]|$)")
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
_DOUBLED = [sum(divmod(2 * d, 10)) for d in range(10)]


def luhn(digits: str) -> bool:
    return sum(_DOUBLED[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number (no blanks) read as digits, its first four characters last, leaves 1."""
    rest = 0
    for c in account[4:] + account[:4]:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def emails(text: str):
    """Each domain with the run of name characters before it, not reaching into the one before."""
    free = 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        name = text[max(free, text.rfind("@", free, at) + 1) : at]
        start = at - (len(name) - len(name.rstrip(LOCAL_PART)))
        if start < at:
            yield start, m.end()
            free = m.end()


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    out += [
        ("ip", *m.span()) for m in _IP.finditer(text)
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split("."))
    ]
    out += [("card", a, b) for a, b, digits in digit_runs(text) if 16 <= len(digits) <= 19 and luhn(digits)]
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return out


def digit_runs(text: str):
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            yield *m.span(), _NO_DIGIT.sub("", m[0])


def proposed(text: str):
    """Spans of the further kinds that pass their checksum."""
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield "iban", *m.span()
    for m in _SSN.finditer(text):
        yield "ssn", *m.span()
    for a, b, digits in digit_runs(text):
        if 13 <= len(digits) <= 15 and luhn(digits):
            yield "short_card", a, b
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's score, changed by the words around the span, between 0 and 1."""
    around = f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR]}".translate(_LOWER)
    change = RAISE * bool(_FOR[kind].search(around)) - LOWER * bool(_AGAINST.search(around))
    return round(min(1.0, max(0.0, SCORES[kind] + change)), 2)


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text."""
    if not text:
        return []
    plain = plain_spans(text)
    out = [(*s, score(text, *s)) for s in plain]
    taken = merged([(a, b) for _, a, b in plain])
    for kind, a, b in sorted(proposed(text), key=lambda s: (FURTHER.index(s[0]), s[1])):
        stands_alone = not (text[a - 1 : a].isalnum() if a else False) and not text[b : b + 1].isalnum()
        if stands_alone and (value := score(text, kind, a, b)) >= LEAST and not touches(taken, a, b):
            out.append((kind, a, b, value))
    return out


def merged(taken: list[tuple[int, int]]) -> list[list[int]]:
    """The same positions as intervals that do not touch each other."""
    out: list[list[int]] = []
    for a, b in sorted(taken):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def touches(taken: list[list[int]], start: int, end: int) -> bool:
    before = bisect_left(taken, [end])
    return before > 0 and taken[before - 1][1] > start


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with the spans of every whole text."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), s)) for s in spans(t)] for t in texts], dtype=object)

    return docs.withColumn(out, run(F.col(text)))


def as_text(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == F.lit(kind))).cast("long")
