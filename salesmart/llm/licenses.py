"""License scan: winnowed template fingerprints, then banded alignment.

Texts and templates are word sequences: separators split, ASCII punctuation
round a word is dropped, A-Z lower-cased, words of punctuation alone left out
(so comment markers do not matter). Of a template's ``GRAM``-word grams the
least hash of every ``WINDOW`` consecutive ones is kept; these fingerprints and
their places form an inverted index. All grams of a text are looked up in it, so
any run of GRAM + WINDOW - 1 words of a template is found. Hits of one template
near one diagonal make a candidate, which a banded alignment of the template
with the text confirms: matched coverage and the span of the matched words.

Templates are a parameter of bounded size (``MAX_TEMPLATE_WORDS`` in all),
indexed once on the driver. Texts never leave their task, no shuffle.
"""

from __future__ import annotations

import re
import string

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_rows
from salesmart.llm.near_dedup import MEMO_WORDS, mix64

GRAM = 3
WINDOW = 3
MIN_COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 200_000

# Wording of public license notices.
TEMPLATES = {
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "MIT/notice": "Released under the MIT License.",
    "MIT/notice-2": "Licensed under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0/notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0/header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0/header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "BSD/conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "MPL-2.0/header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-NC-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0/notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0/long": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "Unlicense/text": "This is free and unencumbered software released into the public domain.",
}

_PUNCTUATION = string.punctuation.encode()
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FACTORS = mix64(np.arange(1, GRAM + 1, dtype=np.uint64)) | np.uint64(1)


class _NormalHashes(dict):
    """Raw word to the hash of its normal form; 0 if nothing is left of it."""

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        word = raw.strip(_PUNCTUATION)
        value = xxhash.xxh64_intdigest(word) | 1 if word else 0
        self[raw] = value
        return value


def _hashes(text: str, memo: _NormalHashes) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split()
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def _grams(h: np.ndarray) -> np.ndarray:
    n = len(h) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = h[:n] * _FACTORS[0]
    for j in range(1, GRAM):
        acc += h[j : j + n] * _FACTORS[j]
    return mix64(acc)


def winnow(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the kept grams: the rightmost least of every window (of all, if there is but one)."""
    n = len(grams)
    if n <= window:
        return np.arange(n)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.unique(np.arange(n - window + 1) + window - 1 - views.argmin(axis=1))


def align(template: np.ndarray, words: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """Matched words of the best banded alignment, and its first and last text place (end exclusive).

    Row i (template word) is aligned within ``band`` of place ``i + shift``;
    text before and after the template is free. A match counts 2, a changed,
    missing or added word -1; among equal scores the one with most matches.
    """
    m, n = len(template), len(words)
    width = 2 * band + 1
    low = -(1 << 30)
    # state: (score, matches, -start); column k of row i stands for place i + shift + k - band
    previous = [(0, 0, -max(0, min(n, shift + k - band))) for k in range(width + 1)]
    for i in range(m):
        row = []
        word = template[i]
        left = (low, 0, 0)
        for k in range(width):
            j = i + shift + k - band
            best = (previous[k + 1][0] - 1, previous[k + 1][1], previous[k + 1][2]) if k + 1 < width else (low, 0, 0)
            if 0 <= j < n:
                score, matches, start = previous[k]
                if words[j] == word:
                    best = max(best, (score + 2, matches + 1, start if matches else -j))
                else:
                    best = max(best, (score - 1, matches, start))
            best = max(best, (left[0] - 1, left[1], left[2]))
            row.append(best)
            left = best
        row.append((low, 0, 0))
        previous = row
    k, (score, matches, start) = max(enumerate(previous[:width]), key=lambda x: x[1])
    end = max(0, min(n, m - 1 + shift + k - band + 1))
    return matches, -start, end


class Scanner:
    """Templates indexed by their winnowed fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.memo = _NormalHashes()
        self.names = sorted(templates)
        self.words = []
        entries = []
        for t, name in enumerate(self.names):
            h = _hashes(templates[name], self.memo)
            h = h[h != 0]
            self.words.append(h)
            grams = _grams(h)
            entries += [(int(grams[p]), t, int(p)) for p in winnow(grams)]
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError("templates have more words than MAX_TEMPLATE_WORDS")
        entries.sort()
        self.keys = np.array([e[0] for e in entries], np.uint64)
        self.places = [e[1:] for e in entries]

    def scan(self, text: str | None, min_coverage: float = MIN_COVERAGE) -> list[tuple[str, float, int, int]]:
        """``(template, coverage, start, end)`` by start; code points, end exclusive; none overlap."""
        if not text or not len(self.keys):
            return []
        raw = _hashes(text, self.memo)
        kept = np.flatnonzero(raw)
        h = raw[kept]
        grams = _grams(h)
        at = np.searchsorted(self.keys, grams)
        hit = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == grams)
        if not len(hit):
            return []
        seeds: dict[int, list[tuple[int, int]]] = {}
        for place in hit.tolist():
            k = int(at[place])
            while k < len(self.places) and self.keys[k] == grams[place]:
                t, p = self.places[k]
                seeds.setdefault(t, []).append((place - p, place))
                k += 1
        found = []
        for t, diagonals in seeds.items():
            template = self.words[t]
            m = len(template)
            band = max(4, m // 8)
            groups: list[list[int]] = []
            for shift, _ in sorted(set(diagonals)):
                if groups and shift - groups[-1][0] <= band:
                    groups[-1][1] = shift
                else:
                    groups.append([shift, shift])
            for first, last in groups:
                shift = (first + last) // 2
                matches, a, b = align(template, h, shift, band)
                if m and matches >= min_coverage * m and b > a:
                    found.append((matches, matches / m, t, a, b))
        if not found:
            return []
        found.sort(key=lambda x: (-x[0] * x[1], x[2], x[3]))
        chosen: list[tuple[int, int, float, int]] = []
        for _, coverage, t, a, b in found:
            if all(b <= c or d <= a for c, d, _, _ in chosen):
                chosen.append((a, b, coverage, t))
        spans = [m.span() for m in _WORD.finditer(text)]
        return [
            (self.names[t], coverage, spans[kept[a]][0], spans[kept[b - 1]][1])
            for a, b, coverage, t in sorted(chosen)
        ]


MATCHES = "array<struct<license:string,template:string,coverage:double,start:int,end:int>>"


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """``(doc_id, n_matches, licenses, best_coverage, matches)`` of every row.

    ``licenses`` are the distinct names before the templates' ``/``, sorted,
    comma-joined. A null or empty text has no match; repeated rows and null ids
    are kept as rows; an empty table or no template gives no match. Other
    columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dict(TEMPLATES if templates is None else templates))

    def factory():
        scanner = Scanner(sent.value)

        def row(doc_id, text):
            found = scanner.scan(text, min_coverage)
            matches = [
                {"license": t.split("/")[0], "template": t, "coverage": c, "start": a, "end": b}
                for t, c, a, b in found
            ]
            names = ",".join(sorted({x["license"] for x in matches}))
            best = max((x["coverage"] for x in matches), default=0.0)
            return doc_id, len(matches), names, best, matches

        return row

    factory.is_factory = True
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(
        source,
        factory,
        f"doc_id long, n_matches long, licenses string, best_coverage double, matches {MATCHES}",
    )
