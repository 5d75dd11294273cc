"""Periodic runs of words by the branching-tandem test over an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends; those of at least ``min_exponent`` periods and
``min_length`` words are found. Over the suffix array (SA, its inverse ISA and
the LCP array; intervals of equal prefixes, no tree):

1. Every LCP interval of depth d is cut into its children. The suffixes i of all
   but the largest child are asked whether ISA[i + d] or ISA[i - d] lies in the
   interval: then a square of period d begins at i or at i - d. It is branching
   if the word after it differs from the word d before that.
2. A run ends with exactly one branching square of its period, so the square at
   b belongs to a run of ``min_exponent`` periods if ISA[b - d], ISA[b - 2d], ...
   are in the interval too.
3. The square is rotated to the left as long as words d apart are equal. Squares
   with the same end whose period is a multiple of a shorter one's, inside that
   run, are powers of it and merge into it.

How it scales: documents are independent, so there is no shuffle; a task sorts
the suffixes of a few documents at a time (``GROUP_WORDS`` words, or one longer
document), words numbered apart for each document so that nothing matches
across documents. Documents without a repeated stretch as long as a run must
hold are set aside after one sort. Work is n log n for n words, memory about
4 bytes a word for each doubling of the longest repeat.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_batches

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words whose suffixes are sorted together.
GROUP_WORDS = 200_000

Run = tuple[int, int, int]


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space and \\x09-\\x0D."""
    return text.encode("utf-8", "replace").split() if text else []


# --- the suffix array of a few documents


def number_words(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each text's own and closed by an end symbol; where each text begins."""
    symbols: list[int] = []
    starts = [0]
    base = 0
    for words in texts:
        known: dict[bytes, int] = {}
        known_or_new = known.setdefault
        symbols += [known_or_new(w, base + len(known)) for w in words]
        base += len(known)
        symbols.append(base)
        base += 1
        starts.append(len(symbols))
    return np.array(symbols, np.int64), np.array(starts, np.int64)


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and for each k the suffixes' ranks by their first 2**k symbols.

    Prefix doubling; suffixes told apart already are not sorted again. Every
    text ends with a symbol of its own, so an equal prefix never reaches past it.
    """
    n = len(symbols)
    place = np.arange(n, dtype=np.int32)
    sa = np.argsort(symbols, kind="stable").astype(np.int32)
    ordered = symbols[sa]
    new = np.append(True, ordered[1:] != ordered[:-1])
    first = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, np.int32)
    rank[sa] = first
    levels = [rank]
    slots = place[~(new & np.append(new[1:], True))]
    reach = 1
    while len(slots):
        suffixes = sa[slots]
        key = levels[-1][suffixes].astype(np.int64) * n + levels[-1][suffixes + reach]
        order = np.argsort(key, kind="stable")
        suffixes, key = suffixes[order], key[order]
        sa[slots] = suffixes
        new = np.append(True, key[1:] != key[:-1])
        first = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank = levels[-1].copy()
        rank[suffixes] = first
        levels.append(rank)
        slots = slots[~(new & np.append(new[1:], True))]
        reach *= 2
    return sa, levels


def lcp_array(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """``lcp[t]``: common symbols of the suffixes at t - 1 and t; from the ranks, longest power first."""
    lcp = np.zeros(len(sa), np.int64)
    left, right = sa[:-1].astype(np.int64), sa[1:].astype(np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        equal = np.flatnonzero(rank[left] == rank[right])  # at most as far as a text's end symbol
        left[equal] += 1 << k
        right[equal] += 1 << k
        lcp[equal + 1] += 1 << k
    return lcp


def smaller_neighbours(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the last one before and the first one after it with a smaller value."""
    values = lcp.tolist()
    n = len(values)
    before, after = [0] * n, [n] * n
    stack = [0]
    for t in range(1, n):
        value = values[t]
        while values[stack[-1]] > value:
            after[stack.pop()] = t
        top = stack[-1]
        before[t] = before[top] if values[top] == value else top
        stack.append(t)
    return np.array(before, np.int64), np.array(after, np.int64)


def smaller_children(lcp: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Slots of all but the largest child of every LCP interval of ``least`` suffixes or more.

    Returned with each slot's interval: its depth, first slot and end.
    """
    before, after = smaller_neighbours(lcp)
    cut = np.flatnonzero((lcp > 0) & (after - before >= least))
    if not len(cut):
        return (np.empty(0, np.int64),) * 4
    cut = cut[np.lexsort((cut, lcp[cut], before[cut]))]
    depth, low, high = lcp[cut], before[cut], after[cut]
    opens = np.append(True, (low[1:] != low[:-1]) | (depth[1:] != depth[:-1]))
    closes = np.append(opens[1:], True)
    group = np.cumsum(opens) - 1
    # a child ends at each cut of its interval, the last one at the interval's end
    begin = np.append(np.where(opens, low, np.append(0, cut[:-1])), cut[closes])
    end = np.append(cut, high[closes])
    owner = np.append(group, group[closes])
    of = np.append(np.arange(len(cut)), np.flatnonzero(closes))
    order = np.lexsort((end - begin, owner))
    largest = np.append(owner[order][1:] != owner[order][:-1], True)
    rest = order[~largest]
    begin, size, of = begin[rest], (end - begin)[rest], of[rest]
    slots = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    of = np.repeat(of, size)
    return slots, depth[of], low[of], high[of]


def branching_squares(
    symbols: np.ndarray, sa: np.ndarray, lcp: np.ndarray, exponent: int
) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of the branching squares that ``exponent`` periods lead up to, in that order."""
    n = len(sa)
    slots, depth, low, high = smaller_children(lcp, exponent)
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)

    def inside(suffix: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        at = isa[np.maximum(suffix, 0)]
        return (suffix >= 0) & (at >= low) & (at < high)

    suffix = sa[slots].astype(np.int64)
    found = []
    for begin, other in ((suffix, suffix + depth), (suffix - depth, suffix - depth)):
        hit = np.flatnonzero(inside(other, low, high))
        begin, d, lo, hi = begin[hit], depth[hit], low[hit], high[hit]
        keep = symbols[begin + d] != symbols[begin + 2 * d]
        for k in range(1, exponent - 1):
            keep &= inside(begin - k * d, lo, hi)
        found.append(np.stack([begin[keep] + 2 * d[keep], d[keep]]))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pairs[0], pairs[1]


def _rotated(symbols: np.ndarray, begin: int, period: int) -> int:
    """The first place from which on, up to ``begin``, symbols a period apart are equal."""
    step = 64
    while begin > 0:
        low = max(0, begin - step)
        differ = np.flatnonzero(symbols[low:begin] != symbols[low + period : begin + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        begin, step = low, step * 2
    return begin


def _merged(symbols: np.ndarray, ends: np.ndarray, periods: np.ndarray, min_length: int) -> list[Run]:
    """(start, length, period) of the runs that the squares lead to."""
    runs: list[Run] = []
    here: list[tuple[int, int]] = []
    at = -1
    for end, period in zip(ends.tolist(), periods.tolist()):
        if end != at:
            at, here = end, []
        if any(period % q == 0 and length >= 2 * period for q, length in here):
            continue
        start = _rotated(symbols, end - 2 * period, period)
        here.append((period, end - start))
        if end - start >= min_length:
            runs.append((start, end - start, period))
    return runs


def _repeat_needed(min_length: int, exponent: int) -> int:
    """The shortest repeat that a run of any period holds: itself less one period."""
    return max(1, min(max(min_length, exponent * q) - q for q in range(1, min_length + 1)))


def _with_repeats(texts: Sequence[list[bytes]], needed: int) -> list[int]:
    """Numbers of the texts in which some stretch of ``needed`` words may come twice (by its hash)."""
    symbols, starts = number_words(texts)
    n = len(symbols) - needed + 1
    if n < 2:
        return []
    factor, key = np.uint64(0x9E3779B97F4A7C15), np.zeros(n, np.uint64)
    for j in range(needed):
        key = (key ^ symbols[j : j + n].astype(np.uint64)) * factor
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    key = key[order]
    twice = order[1:][key[1:] == key[:-1]]
    return np.unique(np.searchsorted(starts, twice, side="right") - 1).tolist()


def find_runs(
    texts: Sequence[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[list[Run]]:
    """For each text (a list of words) its runs (start, length, period) by start, then period.

    ``min_exponent`` is 2 or more.
    """
    out: list[list[Run]] = [[] for _ in texts]
    chosen = _with_repeats(texts, _repeat_needed(min_length, min_exponent))
    if not chosen:
        return out
    symbols, starts = number_words([texts[k] for k in chosen])
    sa, levels = suffix_ranks(symbols)
    lcp = lcp_array(sa, levels)
    del levels
    ends, periods = branching_squares(symbols, sa, lcp, min_exponent)
    for start, length, period in sorted(_merged(symbols, ends, periods, min_length)):
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[chosen[k]].append((start - int(starts[k]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), np.bool_)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return [w for w, gone in zip(words, drop.tolist()) if not gone]


# --- over a table


def _scan(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    schema: str,
    words_for: Callable[[int | None, str | None], list[bytes]],
    row: Callable[[int | None, list[bytes], list[Run]], tuple],
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``row(doc_id, words, runs)`` of every document, a few documents' suffixes sorted at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            found = find_runs(texts, min_length, min_exponent)
            rows = [row(*values) for values in zip(ids, texts, found)]
            arrays = [pa.array(v, type=f.type) for v, f in zip(zip(*rows), out_schema)]
            return pa.RecordBatch.from_arrays(arrays, schema=out_schema)

        ids, texts, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = words_for(doc_id, text)
                    ids.append(doc_id)
                    texts.append(words)
                    size += len(words) + 1
                    if size >= GROUP_WORDS:
                        yield results(ids, texts)
                        ids, texts, size = [], [], 0
        if ids:
            yield results(ids, texts)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(source, run, schema)


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``(doc_id, runs array<struct<start, length, period>>, collapsed)`` of every row.

    ``collapsed`` is the text without the words that a run holds after its first
    period, joined by one space. A null or empty text has no runs and an empty
    ``collapsed``; null and repeated ids are rows like any other; an empty table
    gives an empty result; other columns are ignored.
    """
    return _scan(
        docs,
        id_col,
        text_col,
        "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
        lambda _, text: words_of(text),
        lambda doc_id, words, runs: (
            doc_id,
            [{"start": s, "length": n, "period": p} for s, n, p in runs],
            b" ".join(collapse(words, runs)).decode("utf-8"),
        ),
        min_length,
        min_exponent,
    )


def with_repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, for every tenth id (by its CRC-32) with a tail that repeats its own beginning."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def run_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``DIGEST`` of every row, its words taken by ``with_repeated_tail`` (a null id: as they are).

    ``start``, ``length``, ``period`` and ``exponent_milli`` are those of the
    longest run (ties: smallest start, then period), null without runs. Null,
    empty, repeated and extra input is treated as in ``periodic_runs``.
    """

    def row(doc_id, words, runs):
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listing = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        return (
            doc_id,
            len(runs),
            *top,
            1000 * top[1] // top[2] if runs else None,
            hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest(),
        )

    return _scan(
        docs,
        id_col,
        text_col,
        DIGEST,
        lambda doc_id, text: with_repeated_tail(doc_id, words_of(text)),
        row,
    )
