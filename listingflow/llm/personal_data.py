"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Every kind has a pattern, a check (parts of an address, Luhn, mod 97, number of digits) and a base score.  Words before and after
a span that speak of its kind raise the score, words of another subject lower it.  A span is reported from ``threshold``
on.  The base kinds (e-mail, address, card, phone) are reported whenever their check passes, whatever stands near.

All patterns are read in time linear in the text, whatever it holds.  Offsets count code points, the end is exclusive.

Defined results: a null or empty text has no spans; null ids and repeated rows are ordinary rows, one result each; texts of any
length are read whole; other columns are passed by; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, released, ship_code


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "short_card")

# The patterns of the base kinds, cut so that none is tried twice from the same run of characters.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# Words that speak for or against a kind.
_FOR = {
    "email": "email e-mail mail contact write correo courriel",
    "ip": "ip address host server login dirección adresse",
    "card": "card visa mastercard amex credit debit payment tarjeta carte karte",
    "phone": "phone tel telephone call mobile fax teléfono téléphone telefon",
    "iban": "iban account bank transfer konto cuenta compte",
    "ssn": "ssn social security sozialversicherung",
}
_FOR["short_card"] = _FOR["card"]
_AGAINST = frozenset("version isbn issn serial part model example test sample".split())
_FAVOUR = {kind: frozenset(words.split()) for kind, words in _FOR.items()}
# Base score of a confirmed span; a word for it adds 0.35, a word against it takes 0.3 away.
_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "short_card": 0.3}
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def luhn(digits: str) -> bool:
    """Whether the digits' check digit is right: every second one from the right is doubled, its digits added up."""
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number's check digits are right: moved to the end and read as a number, letters from 10 on."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        parts, start = run.group().split("."), run.start()
        for first in range(0, len(parts) - 3, 4):
            own = parts[first : first + 4]
            end = start + sum(map(len, own)) + 3
            # zeros in front are cut, as int() refuses texts of thousands of digits
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in own):
                yield start, end
            start = end + 1


def _numbers(text: str) -> Iterator[tuple[int, int, str]]:
    for run in _DIGITS.finditer(text):
        yield run.start(), run.end(), run.group().replace(" ", "").replace("-", "")


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans, each kind left to right."""
    if "@" in text:
        yield from (("email", *s) for s in emails(text))
    yield from (("ip", *s) for s in addresses(text))
    for start, end, digits in _numbers(text):
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield ("card" if len(digits) >= 16 else "short_card"), start, end
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        whole = m.group().replace(" ", "")
        if 15 <= len(whole) <= 34 and mod97(whole):
            yield "iban", m.start(), m.end()
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end()


def find(text: str, threshold: float = 0.5, before: int = 48, after: int = 24) -> list[Span]:
    """The spans of a text, by kind and start.

    Context words are looked for in ``before`` characters in front of a span and ``after`` behind it.
    """
    if not _ANY_DIGIT.search(text) and "@" not in text:
        return []
    out = []
    for kind, start, end in _proposed(text):
        near = text[max(0, start - before) : start] + " " + text[end : end + after]
        words = {w.lower() for w in _WORD.findall(near)}
        score = _SCORE[kind] + 0.35 * bool(words & _FAVOUR[kind]) - 0.3 * bool(words & _AGAINST)
        if kind in BASE_KINDS or score >= threshold:
            out.append(Span(kind, start, end, round(min(1.0, max(0.0, score)), 2)))
    return sorted(out, key=lambda s: (KINDS.index(s.kind), s.start))


_ANY_DIGIT = re.compile("[0-9]")


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are one, named by the first."""
    out, done, name, start = [], 0, "", -1
    for s in [*sorted(spans, key=lambda s: (s.start, -s.end)), Span("", len(text), len(text), 0)]:
        if start >= 0 and s.start >= end:
            out += [text[done:start], f"<{name.upper()}>"]
            done, start = end, -1
        if s.kind:
            name, start, end = (s.kind, s.start, s.end) if start < 0 else (name, start, max(end, s.end))
    return "".join(out) + text[done:]


SPANS = "spans array<struct<kind:string,start:int,end:int,score:double>>"


def spans_of(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row: kind, start, end and score of each span, by kind and start; no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in released(batches):
            found = [[s._asdict() for s in find(t.as_py() or "", threshold)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, {SPANS}")


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of ``spans_of``'s result: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, partial(_same, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    sha = F.sha2(_named(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, sha, _named(F.col("spans")).alias("spans"))


def _same(kind: str, found: Column) -> Column:
    return found == kind


def _named(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", threshold: float = 0.5) -> DataFrame:
    """``docs`` with every span in its texts replaced by its kind; a length column is brought up to date; nulls stay null."""
    ship_code(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            columns = {name: batch.column(i) for i, name in enumerate(names)}
            texts = columns[text_col].to_pylist()
            new = [None if t is None else redact(t, find(t, threshold)) for t in texts]
            columns[text_col] = pa.array(new, columns[text_col].type)
            if length_col in columns:
                old = columns[length_col]
                lengths = [n if t == u or u is None else len(u) for n, t, u in zip(old.to_pylist(), texts, new, strict=True)]
                columns[length_col] = pa.array(lengths, old.type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(run, docs.schema)
