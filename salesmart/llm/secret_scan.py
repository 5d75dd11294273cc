"""Secrets by assignment-aware lexing.

Source and configuration text is lexed round every ``=`` and ``:`` into
name-literal pairs: ``name = "a" + b``, ``{"name": "..."}``, ``name: value``,
``export NAME=value``, ``name: type = "..."``, ``names["name"] = "..."``. A
literal may have a prefix, one, three or back quotes, stand in round or square
brackets or on the next line, and be continued by the next literal. A name that was bound to literals earlier in the text is
a constant; where it is used in a later value, its literals are propagated to
the new name. A literal is scored by the words of its target's name and by its
own shape; one that scores ``MIN_SCORE`` or more is a finding of kind
``literal``. The base kinds ``assign``, ``access`` and ``hex`` are found by
expression and always reported; a literal inside a base span is not repeated,
one that goes beyond it is reported as well.

Every text is scanned whole inside its own task, no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_rows, map_same_columns, span_text

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")
MIN_SCORE = 0.5
PLACEHOLDER = "[SECRET]"

# Words of a sensitive name and their weights.
NAME_WEIGHTS = {
    "password": 1.0,
    "passwd": 1.0,
    "pwd": 1.0,
    "passphrase": 1.0,
    "secret": 1.0,
    "token": 1.0,
    "apikey": 1.0,
    "credential": 1.0,
    "credentials": 1.0,
    "bearer": 0.8,
    "authorization": 0.8,
    "auth": 0.7,
    "pass": 0.7,
    "key": 0.4,
}
#: Words that make a ``key`` a secret one.
KEY_WORDS = frozenset({"api", "access", "private", "secret", "auth", "encryption", "signing", "master"})

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Targets are matched from their separator backwards, on the reversed text before it.
_NAME = r"[A-Za-z0-9_.-]*[A-Za-z_]"
_TARGET = re.compile(rf"""[|&?+:]*[ \t]*["'`]?((?:\][^\[\]\n]*\[[ \t]*)+(?:{_NAME})?|{_NAME})""")
_GO_TARGET = re.compile(rf"[ \t]*(?:gnirts\*?|(?:etyb|enur)\]\[)[ \t]+({_NAME})[ \t]+(?:rav|tsnoc)(?![A-Za-z0-9_])")
_TYPE = re.compile(
    r"""[ \t]*[&*]*(?:'[a-z_]+[ \t]+)?(?:mut[ \t]+)?[A-Za-z_][A-Za-z0-9_.]*+(?:[ \t]*+[\[<|&?!*][A-Za-z0-9_.,|&*?!<>\[\] \t'"]*+)?[ \t]*+"""
)
_QUOTED = re.compile(
    r"""(?:[rbfuRBFUL]{1,2}|u8|b?r\#+|[@$]{1,2})?(?:"{3}(?P<d3>(?:[^"\\]|\\[\s\S]|"{1,2}(?!"))*+)"{3}|'{3}(?P<s3>(?:[^'\\]|\\[\s\S]|'{1,2}(?!'))*+)'{3}|"(?P<d>(?:[^"\\\n]|\\.)*+)"|'(?P<s>(?:[^'\\\n]|\\.)*+)'|`(?P<b>(?:[^`\\]|\\[\s\S])*+)`)\#*"""
)
_PLAIN = re.compile(
    r"""[ \t]*(?:(?P<name>[A-Za-z_][A-Za-z0-9_.]*)(?![A-Za-z0-9_.+/=-])|(?P<bare>[^\s"'`,;(){}\[\]]+))"""
)
#: Between a separator and a quoted literal, or two parts of a value.
_GAP = re.compile(r"(?:\s|\\\r?\n)*+")
_OPEN = re.compile(r"(?:\s|\\\r?\n|[(\[])*+")
_KEY_AFTER = re.compile(r"[ \t]*(?::|=(?!=))")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SEPARATOR = re.compile(r"[=:\[]")
#: A literal that is a placeholder as a whole.
_WORN = re.compile(
    r"\$\{[^{}]*\}|\$\([^()]*\)|\$[A-Z_][A-Z0-9_]*|\$[A-Za-z_]+|<[^<>]*>|\{\{[^{}]*\}\}|\{[A-Za-z_][A-Za-z0-9_. ]*\}|%[A-Za-z_][A-Za-z0-9_]*%|%\([^()]*\)s"
)


def name_weight(name: str) -> float:
    """How sensitive a target name is, from 0 to 1."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    weight = max((NAME_WEIGHTS.get(p, 0.0) for p in parts), default=0.0)
    if "key" in parts and KEY_WORDS.intersection(parts):
        weight = 1.0
    return weight


def literal_quality(value: str) -> float:
    """0 for short or worn literals, to 1 for long ones of many different characters."""
    if len(value) < 6 or _WORN.fullmatch(value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    mixed = sum(bool(re.search(x, value)) for x in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.25 * entropy * (0.7 + 0.15 * mixed))


def _target(text: str, at: int, before: int, earlier: int, opened: tuple[int, int]) -> str | None:
    """The name that the separator at ``at`` binds; ``before``, ``earlier``: the two separators before it.

    ``opened``: the last ``[`` and the separator before it. A subscript belongs
    to the name; a type between the name and ``=`` does not, unless it is the
    more sensitive word (``note: token = ...``).
    """
    back = text[before + 1 : at][::-1]
    close = at - 1 - (len(back) - len(back.lstrip("|&?+ \t")))
    # a subscript may hold separators
    if back and opened[0] >= 0 and text[close] == "]" and text.rfind("]", opened[0], close) < 0:
        back = text[opened[1] + 1 : at][::-1]
    left = _TARGET.match(back)
    name = left.group(1)[::-1] if left else None
    if text[at] == "=":
        typed = None
        if before >= 0 and text[before] == ":" and _TYPE.fullmatch(text, before + 1, at):
            typed = _TARGET.match(text[earlier + 1 : before][::-1])
        typed = typed or _GO_TARGET.match(back)
        if typed:
            declared = typed.group(1)[::-1]
            if not name or name_weight(declared) >= name_weight(name):
                return declared
    return name


def _quoted(text: str, pos: int, gap: re.Pattern) -> tuple[int, int, int] | None:
    """``(start, end, after)`` of a literal that follows the gap; on a later line it must not be a key."""
    begin = gap.match(text, pos).end()
    m = _QUOTED.match(text, begin)
    if not m or "\n" in text[pos:begin] and _KEY_AFTER.match(text, m.end()):
        return None
    return *m.span(m.lastgroup), m.end()


def _value(text: str, pos: int, known: dict[str, list[tuple[int, int]]]) -> tuple[list[tuple[int, int]], int]:
    """The literals of the value at ``pos``, and where it ends."""
    spans: list[tuple[int, int]] = []
    opened = _OPEN.match(text, pos).end()
    listed = any(c in "([" for c in text[pos:opened])
    gap = _OPEN if listed else _GAP
    while True:
        if found := _quoted(text, pos, gap):
            while found:  # and the literals that continue it
                spans.append(found[:2])
                pos = found[2]
                found = _quoted(text, pos, _GAP)
        elif m := _PLAIN.match(text, gap.match(text, pos).end() if listed else pos):
            if name := m.group("name"):
                if name in known:
                    spans.extend(known[name])
                elif not listed and (m.end() == len(text) or text[m.end()] in "\r\n"):
                    spans.append(m.span("name"))  # an unquoted value of a configuration line
            elif not listed:
                spans.append(m.span("bare"))
            pos = m.end()
        else:
            return spans, pos
        more = _GAP.match(text, pos).end()
        if text[more : more + 1] != "+" and not (listed and text[more : more + 1] == ","):
            return spans, pos
        pos = more + 1


def name_literal_pairs(text: str) -> list[tuple[str, int, int]]:
    """``(target name, start, end)`` of every literal bound to a name, constants propagated."""
    known: dict[str, list[tuple[int, int]]] = {}
    out = []
    done = 0
    before = earlier = -1
    opened = (-1, -1)
    for sep in _SEPARATOR.finditer(text):
        at = sep.start()
        if text[at] == "[":
            opened = (at, before)
            continue
        last, beyond = before, earlier
        before, earlier = at, before
        if at < done or text[at : at + 2] in ("==", "::", ":/") or text[at - 1 : at] in ("=", "!", "<", ">", ":"):
            continue
        name = _target(text, at, last, beyond, opened)
        if not name:
            continue
        pos = at + (2 if text[at : at + 2] in (":=", "=>") else 1)
        spans, end = _value(text, pos, known)
        if spans:
            known[name] = spans = sorted(set(spans))
            out.extend((name, s, e) for s, e in spans)
            done = end
    return out


def _base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if ":" in text or "=" in text:
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` by start, then kind as in KINDS; code points, end exclusive."""
    if not text:
        return []
    base = _base_spans(text)
    scored = [(*x, 1.0) for x in base]
    if ":" in text or "=" in text:
        best: dict[tuple[int, int], float] = {}
        for name, s, e in name_literal_pairs(text):
            score = name_weight(name) * literal_quality(text[s:e])
            if score >= MIN_SCORE:
                best[s, e] = max(score, best.get((s, e), 0.0))
        whole = sorted((b, c) for _, b, c in base)
        starts, ends = [b for b, _ in whole], list(accumulate((c for _, c in whole), max))
        for (s, e), score in best.items():
            k = bisect_right(starts, s)
            if not k or ends[k - 1] < e:
                scored.append(("literal", s, e, score))
    return sorted(scored, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redact(text: str | None) -> str | None:
    """The text with every found span (overlaps merged) replaced by PLACEHOLDER."""
    found = find_spans(text)
    if not found:
        return text
    out, last = [], 0
    for _, s, e, _ in found:
        if s >= last:
            out += [text[last:s], PLACEHOLDER]
        last = max(last, e)
    return "".join(out) + text[last:]


FINDINGS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, findings, redacted)`` of every row; null text: no findings, null.

    Repeated rows and null ids are kept as rows. Other columns are ignored.
    """

    def row(doc_id, text):
        found = [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in find_spans(text)]
        return doc_id, found, redact(text)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(source, row, f"doc_id long, findings {FINDINGS}, redacted string")


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and span digests of every row, from its findings."""

    def row(doc_id, text):
        spans = [x[:3] for x in find_spans(text)]
        base = [x for x in spans if x[0] in BASE_KINDS]
        counts = [sum(x[0] == kind for x in base) for kind in BASE_KINDS]
        digest = hashlib.sha256(span_text(base).encode()).hexdigest()
        return doc_id, *counts, digest, span_text(spans), len(spans) - len(base)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(
        source,
        row,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string, n_literal long",
    )


def redact_documents(
    docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars"
) -> DataFrame:
    """``docs`` with secrets in the text replaced; same columns, types and rows.

    ``length_col``, if present, is the code point count of the new text. Rows
    without a finding are unchanged. Columns may have any names.
    """
    k = docs.columns.index(text_col)
    n = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches):
        import pyarrow as pa

        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            old = batch.column(k).to_pylist()
            new = [redact(x) for x in old]
            columns = list(batch.columns)
            columns[k] = pa.array(new, type=batch.schema.field(k).type)
            if n is not None:
                kept = columns[n].to_pylist()
                lengths = [c if a == b or b is None else len(b) for a, b, c in zip(old, new, kept)]
                columns[n] = pa.array(lengths, type=batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_same_columns(docs, run)
