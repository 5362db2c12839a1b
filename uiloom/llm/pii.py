"""Personal data: patterns propose spans, checks confirm them, words nearby adjust the score.

Base kinds (email, ip, card, phone) are decided by pattern and check alone: leftmost matches that
don't overlap, of each kind by itself; a match that fails its check is dropped without a retry.
Further kinds (iban by mod 97; ssn, which has no checksum) are kept when pattern, check and
context together reach MIN_SCORE. Every span carries a score: 0.5 for the pattern, 0.35 for a
passed checksum, 0.15 for a context word within CONTEXT characters before it.

Positions are code points, the end exclusive. A null text is empty and has no spans. All scans
are linear in the text, so very long texts and runs of digits or letters are no special case. Repeated rows get equal results each, an empty
table gives an empty one. Only id and text are read, so the names of further columns can't clash; masking keeps them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
CONTEXT, MIN_SCORE = 48, 0.6
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
}
NEAR = {kind: re.compile(r"\b(?:" + "|".join(names) + r")\b", re.I) for kind, names in CONTEXT_WORDS.items()}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match starts where a run of digits starts: if it fails there, it fails at every later digit of the run
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, each found from its @ instead of from every letter."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            last = domain.end()
            yield start, last
            at = text.find("@", last)
        else:
            last = at + 1  # no local part reaches back over an @
            at = text.find("@", at + 1)


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """kind, start, end of matches that pass their check, and whether that was a checksum."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end, False
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield "ip", m.start(), m.end(), False
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                yield "phone", m.start(), m.end(), False
    for m in IBAN.finditer(text):
        whole = m.group().replace(" ", "")
        if 15 <= len(whole) <= 34 and mod97(whole):
            yield "iban", m.start(), m.end(), True
    for m in SSN.finditer(text):
        yield "ssn", m.start(), m.end(), False


def find_spans(text: str | None) -> list[Span]:
    """Spans by start, then by place of the kind in KINDS."""
    out: list[Span] = []
    for kind, start, end, checksum in proposals(text or ""):
        near = bool(NEAR[kind].search(text, max(0, start - CONTEXT), start))
        score = 0.5 + 0.35 * checksum + 0.15 * near
        if kind in BASE_KINDS or score >= MIN_SCORE:
            out.append((kind, start, end, round(score, 2)))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def mask(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind in angle brackets; of overlapping spans the first stands for all."""
    out, last = [], 0
    for kind, start, end, _ in spans:
        if start >= last:
            out += text[last:start], f"<{kind.upper()}>"
        last = max(last, end)
    return "".join([*out, text[last:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


SPAN_FIELDS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))
SPAN_DDL = "array<struct<kind:string,start:int,stop:int,score:double>>"


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, spans and the text with its spans masked, a row for each row of df."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            spans = [find_spans(t) for t in texts]
            rows = [[dict(zip(("kind", "start", "stop", "score"), s, strict=True)) for s in found] for found in spans]
            masked = [mask(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, SPAN_FIELDS), pa.array(masked, pa.string())], names=["id", "spans", "masked"])

    source = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return source.mapInArrow(scan, f"id {source.schema['id'].dataType.simpleString()}, spans {SPAN_DDL}, masked string")


def mask_column(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with its text column masked; every other column as it was."""
    names = df.columns
    place = names.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masked = [t if t is None else mask(t, find_spans(t)) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(masked, batch.schema.field(place).type))

    return df.mapInArrow(scan, df.schema)


def summarise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t) for t in batch.column(1).to_pylist()]
            base = [[s for s in spans if s[0] in BASE_KINDS] for spans in found]
            counts = [pa.array([sum(s[0] == kind for s in spans) for spans in base], pa.int64()) for kind in BASE_KINDS]
            digests = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
            scores = [max((s[3] for s in spans), default=0.0) for spans in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array([joined(s) for s in found], pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "top_score"],
            )

    source = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(scan, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, top_score double")
