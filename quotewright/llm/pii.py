"""Personal data with offset-preserving deobfuscation (operator 8).

Plain identifiers are found in the text as it stands. Then a chain of
transducers rewrites the text to what a reader would see: look-alike letters
and digits become ASCII and invisible characters go, runs of spelled digits
become digits, "at" and "dot" disguises become ``@`` and ``.``. Every character
of the result knows the span of source characters it stands for, so spans that
are found there map back to the source. Such a span is added unless a plain
one of its kind contains it; plain fragments of it stay beside it. Offsets count code points; ends are exclusive.

Null and empty texts have no spans. Rows are independent, so ties and repeated
rows need no rule; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The patterns of the four kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starting within a run of digits fails wherever starting at its head fails.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters that look like ASCII ones.
_ALIKE = dict(zip("аеорсухіјѕԁһքԛԝАВЕКМНОРСТХІЈЅαοενικρτυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhfqwABEKMHOPCTXIJSaoevikptuABEZHIKMNOPTYX"))
_ALIKE |= {"․": ".", "。": ".", "﹒": ".", "﹫": "@", "–": "-", "‐": "-", "‑": "-", "−": "-"}
_UNSEEN = "­​‌‍⁠﻿"
# Digits as words.
_SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}

_STRANGE = re.compile("[" + "".join(_ALIKE) + _UNSEEN + "！-～٠-٩۰-۹०-९\U0001d7ce-\U0001d7ff]")
_NUMBER = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_SPOKEN = re.compile(rf"(?i)(?<!\w)(?:plus[ -]+)?(?:(?:{_NUMBER}|[0-9])[ ,.-]{{1,3}}){{6,}}(?:{_NUMBER}|[0-9]+)(?!\w)")
_SPOKEN_PART = re.compile(rf"(?i){_NUMBER}|plus|[0-9]|[ ,.-]+")
_LABEL = r"[A-Za-z0-9-]{1,63}"
_DOT = r"(?: ?[\[({<] ?(?:dot|punkt|point|punto|\.) ?[\])}>] ?| (?:dot|punkt|point|punto) )"
_AT = r"(?: ?[\[({<] ?(?:at|arroba|@) ?[\])}>] ?| (?:at|arroba) | ?@ ?)"
_DISGUISED = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]{{1,64}}(?:(?:\.|{_DOT})[A-Za-z0-9_%+-]{{1,64}}){{0,4}}({_AT}){_LABEL}(?:(?:\.|{_DOT}){_LABEL}){{0,4}}(?:\.|{_DOT})[A-Za-z]{{2,24}}(?![A-Za-z0-9-])"
)
_HINT = re.compile(r"(?i)[\[({<] ?(?:at|arroba|@|dot|punkt|point|punto|\.) ?[\])}>]| (?:dot|punkt|point|punto) | @|@ ")
_NUMBERS = re.compile(rf"(?i)(?<![0-9])[0-9]+(?:(?:\.|{_DOT})[0-9]+){{3}}(?![0-9])")
_AT_OR_DOT = re.compile(rf"(?i){_AT}|{_DOT}")
_ONE_DOT = re.compile(rf"(?i){_DOT}")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Each ``@`` parts a local name, the run of its characters before, from a domain."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(Span("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", at + 1)
    return found


def plain_spans(text: str) -> list[Span]:
    """Identifiers of the text as it stands, ordered by kind and start."""
    found = _emails(text)
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in m[0].split(".")):
            found.append(Span("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(Span("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append(Span("phone", m.start(), m.end()))
    return found


class _Tape:
    """Text whose characters carry the span of source characters they stand for."""

    def __init__(self, text: str, starts, ends):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, text: str) -> _Tape:
        return cls(text, range(len(text)), range(1, len(text) + 1))

    def rewritten(self, changes: list[tuple[int, int, str]]) -> _Tape:
        """Replace [i, j) by a string, in order; its characters share the whole source span."""
        if not changes:
            return self
        text, starts, ends, at = [], [], [], 0
        for i, j, new in changes:
            text += (self.text[at:i], new)
            starts.extend(self.starts[at:i])
            ends.extend(self.ends[at:i])
            starts.extend([self.starts[i]] * len(new))
            ends.extend([self.ends[j - 1]] * len(new))
            at = j
        text.append(self.text[at:])
        starts.extend(self.starts[at:])
        ends.extend(self.ends[at:])
        return _Tape("".join(text), starts, ends)


def _look_alikes(tape: _Tape) -> _Tape:
    def plain(c: str) -> str:
        if c in _UNSEEN:
            return ""
        if c in _ALIKE:
            return _ALIKE[c]
        return unicodedata.normalize("NFKC", c) if "！" <= c <= "～" else str(unicodedata.decimal(c))

    return tape.rewritten([(m.start(), m.end(), plain(m[0])) for m in _STRANGE.finditer(tape.text)])


def _spelled_digits(tape: _Tape) -> _Tape:
    changes = []
    for m in _SPOKEN.finditer(tape.text):
        if not any(c.isalpha() for c in m[0]):
            continue
        for part in _SPOKEN_PART.finditer(tape.text, m.start(), m.end()):
            word = part[0].lower()
            changes.append((part.start(), part.end(), "+" if word == "plus" else _SPELLED.get(word, word if word.isdigit() else "")))
    return tape.rewritten(changes)


def _at_and_dot(tape: _Tape) -> _Tape:
    """A bare " at " counts only with a spelled dot in the domain; else prose would be caught."""
    changes = []
    for m in _DISGUISED.finditer(tape.text) if _HINT.search(tape.text) else ():
        if m[1].strip().isalpha() and not re.search(_DOT, tape.text[m.end(1) : m.end()], re.I):
            continue
        for part in _AT_OR_DOT.finditer(tape.text, m.start(), m.end()):
            at = part.start() == m.start(1)
            changes.append((part.start(), part.end(), "@" if at else "."))
    return tape.rewritten(changes)


def _dots_of_numbers(tape: _Tape) -> _Tape:
    """Disguised dots between four numbers; whether they make an address is left to the pattern."""
    if not _HINT.search(tape.text):
        return tape
    return tape.rewritten([(p.start(), p.end(), ".") for m in _NUMBERS.finditer(tape.text) for p in _ONE_DOT.finditer(tape.text, m.start(), m.end())])


def added_spans(text: str, plain: list[Span]) -> list[Span]:
    """Identifiers that only the rewritten text shows, in source offsets, unless a plain span of the kind holds them."""
    tape = _dots_of_numbers(_at_and_dot(_spelled_digits(_look_alikes(_Tape.of(text)))))
    if tape.text == text:
        return []
    found = []
    for s in plain_spans(tape.text):
        start, end = tape.starts[s.start], tape.ends[s.end - 1]
        changed = text[start:end] != tape.text[s.start : s.end]
        if changed and not any(p.kind == s.kind and p.start <= start and end <= p.end for p in plain):
            found.append(Span(s.kind, start, end))
    return found


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, added spans)."""
    plain = plain_spans(text)
    return plain, added_spans(text, plain)


def spans(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus ``spans array<struct<kind, start, end, disguised>>``."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,disguised:boolean>>")
    def of(texts):
        import pandas as pd

        rows = []
        for text in texts:
            plain, added = find_spans(text)
            rows.append([{**s._asdict(), "disguised": d} for group, d in ((plain, False), (added, True)) for s in group])
        return pd.Series(rows, dtype=object)

    return docs.withColumn("spans", of(F.coalesce("text", F.lit(""))))


def _joined(found: list[Span]) -> str:
    order = sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in order)


def span_digests(docs: DataFrame) -> DataFrame:
    """Counts and digest of the plain spans, and all spans as a string; one pass without an exchange."""
    schema = pa.schema(
        [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
    )

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                plain, added = find_spans(text or "")
                counts = [sum(s.kind == k for s in plain) for k in KINDS]
                rows.append((*counts, hashlib.sha256(_joined(plain).encode()).hexdigest(), _joined(plain + added), len(added)))
            columns = list(zip(*rows)) if rows else [()] * 7
            arrays = [pa.array(c, t.type) for c, t in zip(columns, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    )
