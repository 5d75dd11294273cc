"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared in a normal form: lower case, white-space runs as
one space. An item of m characters has an error budget of ``m * ERROR_PERCENT //
100`` edits and is cut into budget + 1 pieces: whatever the edits, one piece
survives unchanged. All pieces of all items stand in one Aho-Corasick automaton;
a piece found in a text proposes the place where its item would begin, and
Myers' bit-parallel algorithm finds the least edit distance of the item to any
passage there. A passage within the budget is a hit. Before that, a window must
hold enough of the item's four-letter grams (an edit spoils four at most), which
drops no passage within the budget and spares most of the distance work.

Texts never leave their task. Items are sent to every task in blocks of at most
``BLOCK_CHARS`` characters; a larger benchmark takes more passes over the
texts, one for each block, so what is broadcast is bounded.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_batches, map_same_columns
from salesmart.session import scratch_uri

ERROR_PERCENT = 8
BLOCK_CHARS = 8_000_000
#: Items of fewer characters must occur whole (no budget).
MIN_BUDGET_CHARS = 25
GRAM = 4


def normal_form(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget_of(length: int, percent: int = ERROR_PERCENT) -> int:
    return length * percent // 100 if length >= MIN_BUDGET_CHARS else 0


def pieces_of(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` consecutive pieces of near equal length, with their offsets."""
    n, parts = len(item), min(budget + 1, len(item))
    cuts = [n * k // parts for k in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers_best(pattern_masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to a passage of ``text``, and that passage's first end.

    ``pattern_masks``: for each character, the bits of its places in the pattern.
    """
    full = (1 << m) - 1
    top = 1 << (m - 1)
    vp, vn, score = full, 0, m
    best, best_end = m, 0
    get = pattern_masks.get
    for end, c in enumerate(text, 1):
        eq = get(c, 0)
        x = eq | vn
        d0 = ((((eq & vp) + vp) & full) ^ vp) | x
        hp = vn | (full & ~(d0 | vp))
        hn = d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        if score < best:
            best, best_end = score, end
        hp = (hp << 1) & full
        hn = (hn << 1) & full
        vp = hn | (full & ~(d0 | hp))
        vn = d0 & hp
    return best, best_end


def grams_of(text: str) -> list[str]:
    return [text[i : i + GRAM] for i in range(len(text) - GRAM + 1)]


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


class Matcher:
    """The pieces of a block of items, ready to search texts."""

    def __init__(self, items: list[tuple[int, str]], percent: int = ERROR_PERCENT):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normal_form(text)
            if not item:
                continue
            budget = budget_of(len(item), percent)
            k = len(self.items)
            self.items.append(
                (item_id, len(item), budget, masks_of(item), masks_of(item[::-1]), grams_of(item))
            )
            for offset, piece in pieces_of(item, budget):
                pieces.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def hits(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)`` of each item in the normal form: its best passage."""
        doc = normal_form(text)
        if self.empty or not doc:
            return []
        starts: dict[int, set[int]] = {}
        for last, (length, places) in self.automaton.iter(doc):
            at = last + 1 - length
            for k, offset in places:
                starts.setdefault(k, set()).add(at - offset)
        out = []
        for k, where in starts.items():
            item_id, m, budget, forward, backward, grams = self.items[k]
            best = None
            need = len(grams) - GRAM * budget
            windows: list[list[int]] = []
            for s in sorted(where):
                a, b = max(0, s - budget), min(len(doc), s + m + budget)
                if windows and a <= windows[-1][1]:
                    windows[-1][1] = max(b, windows[-1][1])
                else:
                    windows.append([a, b])
            for a, b in windows:
                if b - a < m - budget:
                    continue
                if need > 0 and sum(map(set(grams_of(doc[a:b])).__contains__, grams)) < need:
                    continue
                distance, end = myers_best(forward, m, doc[a:b])
                if distance <= budget and (best is None or distance < best[0]):
                    end += a
                    back = doc[max(0, end - m - budget) : end][::-1]
                    _, length = myers_best(backward, m, back)
                    best = (distance, end - length, end)
            if best:
                out.append((item_id, *best))
        return sorted(out)


@lru_cache(maxsize=2)
def _matcher(items: tuple[tuple[int, str], ...], percent: int) -> Matcher:
    return Matcher(list(items), percent)


HITS = "doc_id long, item_id long, distance int, budget int, start int, end int"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """The items in blocks of bounded size, one block on the driver at a time."""
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")
    ).where("text is not null and item_id is not null")
    total = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-total // (BLOCK_CHARS // 2)))  # half full on average
    for k in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield tuple(sorted((r.item_id, r.text) for r in part.distinct().collect()))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = ERROR_PERCENT,
) -> DataFrame:
    """``HITS``: a row for each (document, benchmark item) found in it, at its best passage.

    ``start`` and ``end`` are places in the text's normal form. Null or empty
    texts and items give no hit, as do items without an id; a row with a null
    id is searched and its hits have a null doc_id; repeated rows give their
    hits again. An empty table on either side gives an empty result.
    """
    import pyarrow as pa

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sc = docs.sparkSession.sparkContext
    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        sent = sc.broadcast(block)

        def run(batches, sent=sent):
            matcher = _matcher(sent.value, percent)
            budgets = {x[0]: x[2] for x in matcher.items}
            for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
                rows = [
                    (doc_id, item_id, distance, budgets[item_id], start, end)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for item_id, distance, start, end in matcher.hits(text)
                ]
                columns = list(zip(*rows)) or [()] * 6
                types = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["doc_id", "item_id", "distance", "budget", "start", "end"],
                )

        hits = map_batches(source, run, HITS)
        out = hits if out is None else out.unionByName(hits)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id has no hit, every column as it was (null ids stay)."""
    spark = docs.sparkSession
    path = scratch_uri(spark, "contaminated")
    hits = find_contamination(docs, benchmark, id_col=id_col, **options)
    hits.select(F.col("doc_id").alias(id_col)).distinct().write.parquet(path)
    gone = spark.read.schema(f"`{id_col}` long").parquet(path)
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)


def drop_contaminated_rows(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = ERROR_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` whose own text has no hit, every column as it was.

    A row is judged where it is read, whatever its id: null and repeated ids
    need no key, columns may have any names. Each block of items is one more
    pass over the rows left.
    """
    import pyarrow as pa

    sc = docs.sparkSession.sparkContext
    k = docs.columns.index(text_col)
    out = docs
    for block in _blocks(benchmark, item_col, item_text_col):
        sent = sc.broadcast(block)

        def run(batches, sent=sent):
            matcher = _matcher(sent.value, percent)
            for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
                clean = [not matcher.hits(text) for text in batch.column(k).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = map_same_columns(out, run)
    return out
