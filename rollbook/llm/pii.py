"""Personal data in texts: patterns propose spans, checksums confirm them, context words move the score.

Base kinds (email, ip, card, phone) are found by fixed patterns and always kept.
Further kinds (IBAN with its mod-97 check, national phone and social security
numbers) are kept if their score, from validator and nearby words, is high enough.
All scans take time in proportion to the text, so very long texts and long runs of
digits are no special case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.words import slices, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_phone", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[^\W\d_]+")

# fixed values: words near a span that speak for its kind
CONTEXT = {
    "email": {"email", "mail", "contact", "write", "correo", "courriel", "kontakt"},
    "ip": {"ip", "address", "host", "server", "login", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono", "téléphone"},
    "iban": {"iban", "bank", "account", "konto", "compte", "cuenta"},
    "national_phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono", "téléphone"},
    "ssn": {"ssn", "social", "security"},
}
# fixed values: score of a span by its form and validator alone
FORM_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "national_phone": 0.4, "ssn": 0.4}
#: What a context word adds, how many characters on each side are looked at, and the score an added span needs.
CONTEXT_SCORE, CONTEXT_CHARS, LEAST_SCORE = 0.3, 40, 0.6


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(text: str) -> bool:
    """Whether an account number of letters and digits passes the mod-97 check."""
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        # what has been looked at need not be looked at again: no name can reach across an @
        done = max(done, at + 1)
        at = text.find("@", done)


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            yield "phone", m.start(), m.end()


def _added(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield "iban", m.start(), m.end()
    for kind, pattern in (("national_phone", _NATIONAL), ("ssn", _SSN)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def find_spans(text: str | None) -> list[Span]:
    """Spans of one text by start, then kind; an added span never overlaps a base one."""
    if not text:
        return []

    def scored(kind: str, start: int, end: int) -> Span:
        near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
        hit = not CONTEXT[kind].isdisjoint(w.lower() for w in _WORD.findall(near))
        return Span(kind, start, end, min(1.0, FORM_SCORE[kind] + CONTEXT_SCORE * hit))

    base = sorted((scored(*s) for s in _base(text)), key=lambda s: (s.start, KINDS.index(s.kind)))
    more = [s for s in (scored(*a) for a in _added(text)) if s.score >= LEAST_SCORE]
    if more:
        covered = sorted((s.start, s.end) for s in base)
        more = [s for s in more if not any(a < s.end and s.start < b for a, b in covered)]
    return sorted(base + more, key=lambda s: (s.start, KINDS.index(s.kind)))


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    for batch in slices(batches):
        found = [[s._asdict() for s in find_spans(t)] for t in texts_of(batch).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "found"])


def personal_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``, the spans of its text: kind, start, end (code points, end exclusive) and score.

    One row per row of ``docs``; null and empty texts have no span. Other columns
    are ignored. One pass, no shuffle.
    """
    return docs.select("doc_id", "text").mapInArrow(_find, f"doc_id long, found {SPANS}")


def masked(docs: DataFrame) -> DataFrame:
    """The documents, every span of the text replaced by its kind in angle brackets; all other columns stay."""
    from pyspark.sql import functions as fn

    @fn.pandas_udf("string")
    def mask(texts):
        def one(text):
            if not text:
                return text
            out, at = [], 0
            for s in find_spans(text):
                if s.start >= at:
                    out += [text[at : s.start], f"<{s.kind}>"]
                at = max(at, s.end)
            return "".join(out) + text[at:]

        return texts.map(one, na_action="ignore")

    return docs.withColumn("text", mask("text"))


def span_text(spans) -> F.Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
