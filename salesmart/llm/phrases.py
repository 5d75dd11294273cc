"""Phrase collocations counted over a prefix-free parse.

A document is a sequence of words and separators (``[.,;:!?\\x0A-\\x0D]``; a
phrase lies between two of them). A pair of adjacent tokens whose hash is 0
modulo ``TRIGGER`` opens a chunk, so equal passages are cut alike wherever they
stand; a chunk reaches over the two tokens that open the next one. The distinct
chunks form a dictionary with the frequency of each in the parse. A phrase of up
to three words is counted in the chunk that holds its first word before the
overlap, weighted by the chunk's frequency: each occurrence once, and a passage
of many copies once for all of them.

How it scales:

1. chunks are combined before and after one shuffle (a chunk of a million copies
   is one row), and written in blocks of ``BLOCK_WORDS`` dictionary words;
2. a block sends each of its distinct phrases once to the phrase's hash range: a
   truncated hash (``SPARE_BITS`` more than the corpus needs), delta-packed, with
   its weighted count. The range adds up and answers with one bit a phrase: whether
   the hash reaches ``min_count``. That is a lossless filter, equal hashes only let
   more pass;
3. a block sends the phrases that passed as text with their counts; these are added
   up exactly, so no result depends on a hash;
4. cuts, scores, containment and ranks are DataFrame joins and aggregates over
   phrases of ``min_count`` or more.

To the driver come the numbers of words and of blocks. Packed rows are blocks x
ranges; for far larger corpora raise ``block_words`` and ``range_keys`` with the
square root of the corpus, as executor memory allows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import map_batches
from salesmart.llm.lm_scoring import pack_counts, unpack_counts
from salesmart.llm.near_dedup import mix64
from salesmart.session import scratch_uri

MAX_WORDS = 3
OVERLAP = MAX_WORDS - 1
TRIGGER = 32
MIN_COUNT = 10
CONTAINED_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
NO_LANG = "und"
#: Shares in which a language's phrases are ranked first.
RANK_SHARES = 8

BLOCK_WORDS = 900_000
#: Distinct phrases of blocks for one range.
RANGE_KEYS = 2_000_000
SPARE_BITS = 10

SEPARATOR = b"\xff"  # no byte of UTF-8 text
_C0, _C1 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _byte_table() -> bytes:
    """A-Z to lower case, tab to space, separators to SEPARATOR."""
    table = bytearray(range(256))
    table[ord("A") : ord("Z") + 1] = bytes(range(ord("a"), ord("z") + 1))
    table[ord("\t")] = ord(" ")
    for c in b".,;:!?\n\x0b\x0c\r":
        table[c] = SEPARATOR[0]
    return bytes(table)


_TABLE = _byte_table()


def tokens_of(text: str) -> list[bytes]:
    """Lower-cased words, and SEPARATOR for each separator; OVERLAP separators at the end."""
    raw = text.encode("utf-8", "replace").translate(_TABLE).replace(SEPARATOR, b" \xff ")
    return raw.split() + [SEPARATOR] * OVERLAP


class TokenHashes(dict):
    """Token to 64-bit hash, computed once for each token it holds."""

    def __missing__(self, token: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[token] = xxhash.xxh64_intdigest(token)
        return value


def chunk_starts(hashes: np.ndarray, trigger: int = TRIGGER) -> np.ndarray:
    """Where chunks begin: at the first token, and at every pair whose hash is 0 modulo ``trigger``."""
    pairs = mix64(hashes[:-1] * _C0 + hashes[1:] * _C1)
    opens = pairs % np.uint64(trigger) == 0
    opens[-1] = False  # the closing separators open none
    opens[0] = True
    return np.flatnonzero(opens)


def chunks_of(text: str, memo: TokenHashes, trigger: int = TRIGGER) -> list[bytes]:
    """The chunks of one text, tokens joined by a space; each owns all tokens but its last OVERLAP."""
    tokens = tokens_of(text)
    if len(tokens) == OVERLAP:
        return []
    hashes = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    starts = chunk_starts(hashes, trigger).tolist()
    ends = [*(s + OVERLAP for s in starts[1:]), len(tokens)]
    return [b" ".join(tokens[a:b]) for a, b in zip(starts, ends)]


def parse(docs: DataFrame, lang_col: str, text_col: str, trigger: int) -> DataFrame:
    """The dictionary: ``(lang, chunk binary, freq)`` of the distinct chunks."""
    schema = pa.schema([("lang", pa.string()), ("chunk", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = TokenHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                langs, chunks = [], []
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = chunks_of(text, memo, trigger)
                    chunks += found
                    langs += [lang] * len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(chunks, pa.binary())], schema=schema
                )

    source = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    ).where(F.col("text") != "")
    found = map_batches(source, run, "lang string, chunk binary")
    return found.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("freq"))


# --- blocks of the dictionary

BLOCK = "block long, n_words long, langs array<string>, lang_words array<long>, lang_of binary, freqs binary, chunks binary"
_BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("n_words", pa.int64()),
        ("langs", pa.list_(pa.string())),
        ("lang_words", pa.list_(pa.int64())),
        ("lang_of", pa.binary()),
        ("freqs", pa.binary()),
        ("chunks", pa.binary()),
    ]
)


def _pack_block(number: int, langs: list[str], chunks: list[bytes], freqs: list[int]) -> pa.RecordBatch:
    """One row; ``lang_words``: the occurrences in the corpus of each language's words here."""
    known = sorted(set(langs))
    at = {lang: k for k, lang in enumerate(known)}
    lang_of = np.array([at[lang] for lang in langs], np.int64)
    owned = np.array([_owned_words(c) for c in chunks], np.int64)
    freq = np.array(freqs, np.int64)
    words = np.zeros(len(known), np.int64)
    np.add.at(words, lang_of, owned * freq)
    row = (
        number,
        int(owned.sum()),
        known,
        words.tolist(),
        pack_counts(lang_of),
        pack_counts(freq),
        zstandard.ZstdCompressor(level=1).compress(b"\n".join(chunks)),
    )
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(row, _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA
    )


def _owned_words(chunk: bytes) -> int:
    body = chunk.rsplit(b" ", OVERLAP)[0]
    return body.count(b" ") + 1 - body.count(SEPARATOR)


def blocks_of(dictionary: DataFrame, block_words: int) -> DataFrame:
    """The dictionary packed into ``BLOCK`` rows, each by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        langs, chunks, freqs, size = [], [], [], 0
        for batch in batches:
            for lang, chunk, freq in zip(*(c.to_pylist() for c in batch.columns)):
                langs.append(lang)
                chunks.append(chunk)
                freqs.append(freq)
                size += chunk.count(b" ") + 1
                if size >= block_words:
                    yield _pack_block(number, langs, chunks, freqs)
                    number, langs, chunks, freqs, size = number + 1, [], [], [], 0
        if chunks:
            yield _pack_block(number, langs, chunks, freqs)

    return map_batches(dictionary, run, BLOCK)


class _Numbers(dict):
    """Numbers words in the order in which they are met, through the given counter."""

    def __init__(self, counter: Iterator[int]):
        super().__init__({SEPARATOR: 0})
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        value = self[word] = next(self.counter)
        return value


class BlockPhrases:
    """The distinct phrases of a block by ascending truncated hash, with their weighted counts."""

    def __init__(self, row: dict, bits: int):
        lines = zstandard.ZstdDecompressor().decompress(row["chunks"]).split(b"\n")
        self.langs = row["langs"]
        # a word counts apart for each language; 0 is the separator
        counter = itertools.count(1)
        known = [_Numbers(counter) for _ in self.langs]
        symbols: list[int] = []
        ends: list[int] = []
        for line, lang in zip(lines, unpack_counts(row["lang_of"]).tolist()):
            symbols += map(known[lang].__getitem__, line.split(b" "))
            ends.append(len(symbols))
        del lines
        word = np.array(symbols, np.int64)
        del symbols
        width = next(counter)
        self.words: list[bytes] = [SEPARATOR] * width
        self.lang = np.zeros(width, np.int64)
        for lang, numbers in enumerate(known):
            for text, number in numbers.items():
                if number:
                    self.words[number] = text
                    self.lang[number] = lang
        del known
        ends_at = np.array(ends, np.int64)
        lengths = np.diff(ends_at, prepend=0)
        owned = np.ones(len(word), np.bool_)
        for k in range(1, OVERLAP + 1):
            owned[ends_at - k] = False
        freq = np.repeat(unpack_counts(row["freqs"]), lengths)
        lang_hash = np.array([xxhash.xxh64_intdigest(x.encode(), 1) for x in self.langs], np.uint64)
        token_hash = np.array([xxhash.xxh64_intdigest(t) for t in self.words], np.uint64)
        word_hash = hashes = mix64(token_hash ^ lang_hash[self.lang])
        at = np.flatnonzero(owned & (word > 0))
        count = np.bincount(word[at], freq[at], width)
        present = np.flatnonzero(count)  # a word may stand in overlaps alone
        self.distinct = [present]
        keys, counts = [hashes[present]], [count[present]]
        part = word
        for length in range(2, MAX_WORDS + 1):
            at = at[word[at + length - 1] > 0]
            last = word[at + length - 1]
            distinct, place = np.unique(part[at] * width + last, return_inverse=True)
            hashes = mix64(hashes[distinct // width] * _C0 + word_hash[distinct % width] * _C1)
            self.distinct.append(distinct)
            keys.append(hashes)
            counts.append(np.bincount(place, freq[at], len(distinct)))
            part = np.zeros(len(word), np.int64)
            part[at] = place
        self.width = width
        key = np.concatenate(keys) >> np.uint64(64 - bits)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]
        self.counts = np.concatenate(counts).astype(np.int64)  # exact: sums below 2**53

    def texts(self, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, n) of the phrases at the given places of the ascending order."""
        chosen = np.sort(self.order[chosen])
        words, langs = pa.array(self.words, pa.binary()), pa.array(self.langs, pa.string())
        sizes = np.cumsum([0, *map(len, self.distinct)])
        for length in range(1, MAX_WORDS + 1):
            low, high = np.searchsorted(chosen, sizes[length - 1 : length + 1])
            for k in range(low, high, 50_000):
                places = chosen[k : min(k + 50_000, high)]
                part = self.distinct[length - 1][places - sizes[length - 1]]
                columns = []
                for shorter in range(length - 1, 0, -1):
                    columns.append(part % self.width)
                    part = part // self.width
                    if shorter > 1:
                        part = self.distinct[shorter - 1][part]
                columns.append(part)
                parts = [words.take(pa.array(c)) for c in reversed(columns)]
                joined = pc.binary_join_element_wise(*parts, b" ") if length > 1 else parts[0]
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(self.lang[part])), joined.cast(pa.string()), pa.array(self.counts[places])],
                    names=["lang", "phrase", "n"],
                )

    def ranges(self, bits: int, range_bits: int) -> np.ndarray:
        """Where each range of the leading ``range_bits`` begins."""
        bounds = np.arange(1 << range_bits, dtype=np.uint64) << np.uint64(bits - range_bits)
        return np.append(np.searchsorted(self.keys, bounds), len(self.keys))


# --- the filter by hash ranges

ASK = "range int, block long, keys binary, counts binary"
ANSWER = "range int, block long, passed binary"


def _asks(blocks: DataFrame, bits: int, range_bits: int) -> DataFrame:
    names = ["range", "block", "keys", "counts"]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                block = BlockPhrases(row, bits)
                bounds = block.ranges(bits, range_bits).tolist()
                counts = block.counts[block.order]
                out = []
                for r, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    if b > a:
                        steps = np.diff(block.keys[a:b], prepend=np.uint64(0))
                        out.append((r, row["block"], pack_counts(steps), pack_counts(counts[a:b])))
                del block, counts
                for k in range(0, len(out), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(zip(*out[k : k + 64]), types)], names=names
                    )

    return map_batches(blocks, run, ASK)


def _answers(asks: DataFrame, min_count: int) -> DataFrame:
    def add_up(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpack_counts(x)) for x in table.column("keys").to_pylist()]
        counts = [unpack_counts(x) for x in table.column("counts").to_pylist()]
        at = np.cumsum([0, *map(len, keys)])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts))
        passed = (total >= min_count)[place]
        packed = [np.packbits(passed[a:b]).tobytes() for a, b in zip(at, at[1:])]
        return pa.table(
            {
                "range": table.column("range"),
                "block": table.column("block"),
                "passed": pa.array(packed, pa.binary()),
            }
        )

    return asks.groupBy("range").applyInArrow(add_up, ANSWER)


def _phrases(blocks: DataFrame, answers: DataFrame, bits: int, range_bits: int) -> DataFrame:
    """``(lang, phrase, n)``: each block's counts of the phrases that passed."""
    grouped = answers.groupBy("block").agg(F.collect_list(F.struct("range", "passed")).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                block = BlockPhrases(row, bits)
                bounds = block.ranges(bits, range_bits)
                chosen = [np.empty(0, np.int64)]
                for answer in row["answers"]:
                    a, b = bounds[answer["range"] : answer["range"] + 2]
                    bit = np.unpackbits(np.frombuffer(answer["passed"], np.uint8), count=b - a)
                    chosen.append(a + np.flatnonzero(bit))
                yield from block.texts(np.concatenate(chosen))

    return map_batches(blocks.join(grouped, "block"), run, "lang string, phrase string, n long")


def phrase_counts(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    trigger: int = TRIGGER,
    block_words: int = BLOCK_WORDS,
    range_keys: int = RANGE_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """Exact counts ``(lang, phrase, f)`` of phrases of 1 to 3 words with ``min_count`` or more, and
    the words ``(lang, n)`` of each language.

    A null lang is ``und``; a null or empty text has no words; rows count as often as
    they come; other columns are ignored; an empty table gives empty results.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_uri(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    blocks = written(blocks_of(parse(docs, lang_col, text_col, trigger), block_words), "phrase-blocks")
    words = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits = min(62, (MAX_WORDS * words).bit_length() + SPARE_BITS)
    range_bits = (max(12, MAX_WORDS * words // range_keys) - 1).bit_length()
    answers = _answers(_asks(blocks, bits, range_bits), min_count)
    passed = _phrases(blocks, answers, bits, range_bits)
    counts = passed.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    totals = (
        blocks.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("x"))
        .groupBy(F.col("x.langs").alias("lang"))
        .agg(F.sum("x.lang_words").alias("n"))
    )
    return written(counts, "phrase-counts"), totals


# --- scores


def _head(phrase: str, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (l * r)), exactly for counts below 10**14."""

    def wide(name: str) -> str:
        return f"cast({name} as decimal(15,0))"

    product = f"cast({wide(a)} * {wide(a)} as decimal(30,0)) * cast({SCALE} as decimal(7,0))"
    return F.expr(f"({product}) div ({wide(left)} * {wide(right)})")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    contained_percent: int = CONTAINED_PERCENT,
    top: int = TOP,
    **parsing: int,
) -> DataFrame:
    """Each language's best phrases of 2 to 3 words: ``(lang, rank, phrase, a, l, r, n, score)``.

    ``a``: the phrase's count (``min_count`` or more); ``l``, ``r``: the counts of its
    parts at the cut of the lowest score (ties: the earliest cut). A phrase inside
    a longer one that has ``contained_percent`` of its count is left out. By score,
    then count, descending, then phrase; the first ``top`` of each language. Null, empty
    and repeated rows, clashing columns and empty tables: see ``phrase_counts``.
    """
    counts, totals = phrase_counts(docs, lang_col, text_col, min_count, **parsing)
    size = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1
    sized = counts.withColumn("words", size)
    candidates = sized.where("words > 1").withColumnRenamed("f", "a")
    cuts = candidates.select(
        "lang",
        "phrase",
        "a",
        "words",
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    ).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("rest"),
    )
    lefts = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"])
    lowest = scored.groupBy("lang", "phrase", "a", "words").agg(
        F.min(F.struct(_score("a", "l", "r").alias("score"), "k", "l", "r")).alias("cut")
    )
    longer = candidates.where(F.col("words") == MAX_WORDS)
    inner = longer.select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(F.array(_head("phrase", 2), _head("phrase", -2))).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(inner, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longer") < contained_percent * F.col("a"), F.lit(True))
    )

    def best(phrases: DataFrame, *group: Column | str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
        return phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # a language's best are among the best of its shares, so no task ranks all of a language
    share = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SHARES))
    ranked = best(best(kept, "lang", share), "lang")
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").alias("score"),
    )
