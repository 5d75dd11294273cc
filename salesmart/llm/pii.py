"""Personal data: expressions propose spans, checksums confirm them, context adjusts the score.

Every text is scanned whole inside its own task, no shuffle. The expressions
are written so that a long run of digits or letters is read once: a digit run
is entered only at its start, an address only from its ``@``.

Kinds: ``email``, ``ip`` (parts to 255), ``card`` (13 to 19 digits, Luhn),
``phone`` (9 to 15 digits) are the base kinds and are always reported.
``iban`` (mod-97) and ``ssn`` (digit groups with their valid ranges) are added
by the method; an ``iban`` is reported also where its digits pass as a card; an
``ssn`` has no checksum, so it needs a context word nearby and characters of its own.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_rows, span_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
CONTEXT_CHARS = 40
ADDED_MIN_SCORE = 0.6

# Context words for each kind (lower case).
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "iban": ("iban", "bank", "account", "transfer", "konto"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
#: Score of a confirmed span without and with a context word.
SCORES = {
    "email": (0.8, 0.95),
    "ip": (0.6, 0.8),
    "card": (0.8, 0.95),
    "phone": (0.7, 0.9),
    "iban": (0.8, 0.95),
    "ssn": (0.4, 0.8),
}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[A-Za-z][A-Za-z-]*")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn_ok(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    moved = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    spans, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            spans.append((start, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", last)
    return spans


def _ips(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 4 and int(p or "0") <= 255 for p in parts):
            out.append(m.span())
    return out


def _cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group()) if m.end() - m.start() <= 37 else ""
        if 13 <= len(digits) <= 19 and luhn_ok(digits):
            out.append(m.span())
    return out


def _phones(text: str) -> list[tuple[int, int]]:
    return [
        m.span() for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15
    ]


def _ibans(text: str) -> list[tuple[int, int]]:
    """Proposals whose longest prefix of whole groups passes mod-97.

    The search goes on from that prefix, or inside a proposal without one, so
    that a proposal never hides what stands behind its start.
    """
    out, at = [], 0
    while m := _IBAN.search(text, at):
        s = m.group()
        cuts = [len(s)] + [k for k in range(len(s) - 1, 14, -1) if s[k] == " "]
        good = next((c for c in cuts if iban_ok(s[:c])), None)
        at = m.start() + (good or 1)
        if good:
            out.append((m.start(), at))
    return out


def _ssns(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            out.append(m.span())
    return out


def _near(text: str, kind: str, start: int, end: int) -> bool:
    """A context word of the kind within CONTEXT_CHARS; a word that the window cuts is none."""
    low, high = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS)
    while low < start and low and text[low - 1].isalnum() and text[low].isalnum():
        low += 1
    while high > end and high < len(text) and text[high - 1].isalnum() and text[high].isalnum():
        high -= 1
    around = text[low:start] + " " + text[end:high]
    return any(w.lower() in CONTEXT[kind] for w in _WORD.findall(around))


def _free(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that share no character with a taken one (both ascending)."""
    ends = [e for _, e in taken]
    out = []
    for s, e in spans:
        k = bisect_left(ends, s + 1)
        if k == len(taken) or taken[k][0] >= e:
            out.append((s, e))
    return out


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` by kind as in KINDS, then start; code points, end exclusive."""
    if not text:
        return []
    found = {"email": _emails(text), "phone": _phones(text) if "+" in text else []}
    found["ip"] = _ips(text)
    found["card"] = _cards(text)
    taken = sorted(s for kind in BASE_KINDS for s in found[kind])
    merged: list[tuple[int, int]] = []
    for s, e in taken:
        if merged and s < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    found["iban"] = _ibans(text)  # confirmed by its own checksum, whatever its digits are besides
    found["ssn"] = _free(_ssns(text), merged)
    out = []
    for kind in KINDS:
        for start, end in found[kind]:
            score = SCORES[kind][_near(text, kind, start, end)]
            if kind in BASE_KINDS or score >= ADDED_MIN_SCORE:
                out.append((kind, start, end, score))
    return out


FINDINGS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, findings)`` of every row; a null or empty text has no findings.

    Repeated rows and null ids are kept as rows. Other columns are ignored.
    """

    def row(doc_id, text):
        return doc_id, [
            {"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in find_spans(text)
        ]

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(source, row, f"doc_id long, findings {FINDINGS}")


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and span digests of every row, from its findings."""

    def row(doc_id, text):
        found = find_spans(text)
        spans = [x[:3] for x in found]
        base = [x for x in spans if x[0] in BASE_KINDS]
        counts = [sum(x[0] == kind for x in base) for kind in BASE_KINDS]
        return (
            doc_id,
            *counts,
            hashlib.sha256(span_text(base).encode()).hexdigest(),
            span_text(spans),
            max((x[3] for x in found), default=0.0),
        )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(
        source,
        row,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string, top_score double",
    )
