"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word's symbols stand in the leaves' order; leaf i holds ``rank << SHIFT | i``
of the pair (symbol i, next symbol), or NONE. Inner nodes hold the minimum, so
the root is the leftmost pair of the lowest rank. A merge changes at most three
leaves, each updated in logarithmic time, until the root is NONE. The trees of all
new words of a batch are worked on together, a merge of each at a time
(``merge_batch``); a word of more than ``BATCH_SYMBOLS`` bytes alone.

The vocabulary file (about 2 MB) is read once on the driver from a path given as
parameter and sent to the tasks; texts never leave their task, no shuffle. A
task keeps the ids of words, and of runs of text between spaces, that it has met
lately, at most 2 * MEMO_WORDS of them. An empty table gives an empty result.
Letter and number classes are those of Python's Unicode tables; characters that
only later Unicode versions assign may be cut otherwise than by other libraries.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from salesmart.llm.common import map_batches

#: Entries of one generation of the memo.
MEMO_WORDS = 100_000
#: Words longer than this are encoded anew each time, so the memo stays small.
MEMO_CHARS = 64
#: Words of more bytes have a tree of their own.
BATCH_SYMBOLS = 126
#: Leaves of the trees that are worked on together.
BATCH_LEAVES = 200_000
#: Texts whose new words are encoded together.
BATCH_TEXTS = 250


def _category_class(letter: str) -> str:
    """The characters of one Unicode major category, as ranges for a character class."""
    runs: list[list[int]] = []
    for code in range(sys.maxunicode + 1):
        if unicodedata.category(chr(code))[0] == letter:
            if runs and runs[-1][1] == code - 1:
                runs[-1][1] = code
            else:
                runs.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def word_pattern() -> re.Pattern:
    """Contractions, letter runs, single numbers, runs of anything else but white space."""
    letters, numbers = _category_class("L"), _category_class("N")
    spaces = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+"
    )


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    spare = 256
    for b in range(256):
        if not out[b]:
            out[b] = chr(spare)
            spare += 1
    return out


def merge_symbols(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merges adjacent symbols by lowest rank, leftmost first, until no pair has a rank.

    ``pairs``: (left, right) -> (rank, merged symbol).
    """
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    shift = n.bit_length()
    low = (1 << shift) - 1
    none = 1 << 62
    get = pairs.get
    symbols = list(symbols)
    following = list(range(1, n + 1))
    previous = list(range(-1, n - 1))
    tree = [none] * (2 * size)
    for i in range(n - 1):
        hit = get((symbols[i], symbols[i + 1]))
        if hit:
            tree[size + i] = hit[0] << shift | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    while (root := tree[1]) != none:
        i = root & low
        j = following[i]
        left = previous[i]
        merged = symbols[i] = get((symbols[i], symbols[j]))[1]
        symbols[j] = -1
        after = following[i] = following[j]
        changed = []
        if j < n - 1:
            changed.append((j, none))
        if after < n:
            previous[after] = i
            hit = get((merged, symbols[after]))
            changed.append((i, hit[0] << shift | i if hit else none))
        else:
            changed.append((i, none))
        if left >= 0:
            hit = get((symbols[left], merged))
            changed.append((left, hit[0] << shift | left if hit else none))
        for leaf, value in changed:
            k = size + leaf
            # up from the leaf, as far as a minimum changes
            while tree[k] != value:
                tree[k] = value
                if k == 1:
                    break
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
    return [s for s in symbols if s >= 0]


class PairTable:
    """The mergeable pairs as sorted arrays: (left, right) to rank, rank to merged symbol."""

    #: Stands before and after a word; no symbol of a vocabulary.
    OUTSIDE = 0xFFFF
    NONE = 1 << 62

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([a << 16 | b for a, b in pairs], np.int64)
        ranks = np.array([r for r, _ in pairs.values()], np.int64)
        merged = np.array([m for _, m in pairs.values()], np.int64)
        if len(keys) and max(map(max, pairs)) >= self.OUTSIDE:
            raise ValueError("vocabularies of more than 65535 symbols are not supported")
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]
        self.merged = np.zeros(int(ranks.max(initial=0)) + 1, np.int64)
        self.merged[ranks] = merged

    def leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, shift: int) -> np.ndarray:
        """``rank << shift | at`` of each pair, NONE where it does not merge."""
        if not len(self.keys):
            return np.full(len(left), self.NONE)
        key = left << 16 | right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.ranks[place] << shift | at, self.NONE)


def merge_batch(words: list[list[int]], table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """``merge_symbols`` of many words of at most ``BATCH_SYMBOLS`` symbols, in arrays.

    Returns all words' symbols one after the other, and how many each word has.

    A row is a word: its symbols at 1 .. n between two OUTSIDE, and its tree, leaf i
    for the pair that begins at i. Each turn merges the root's pair in every row whose
    root is not NONE.
    """
    count = len(words)
    lengths = np.array([len(w) for w in words], np.int64)
    size = 1 << int(lengths.max(initial=1) + 1).bit_length()  # leaves; positions 0 .. n + 1 fit
    shift = size.bit_length()
    symbol = np.full((count, size), PairTable.OUTSIDE, np.int64)
    inside = np.arange(size) < lengths[:, None]
    symbol[:, 1:][inside[:, :-1]] = np.array([s for w in words for s in w], np.int64)
    tree = np.full((count, 2 * size), PairTable.NONE, np.int64)
    at = np.arange(size - 1)
    tree[:, size:-1] = table.leaves(
        symbol[:, :-1].ravel(), symbol[:, 1:].ravel(), np.tile(at, count), shift
    ).reshape(count, -1)
    level = size
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    following = np.tile(np.arange(1, size + 1), (count, 1))
    previous = np.tile(np.arange(-1, size - 1), (count, 1))
    rows = np.arange(count)
    while True:
        root = tree[rows, 1]
        go = root != PairTable.NONE
        rows, root = rows[go], root[go]
        if not len(rows):
            break
        i = root & ((1 << shift) - 1)
        j = following[rows, i]
        before, after = previous[rows, i], following[rows, j]
        merged = table.merged[root >> shift]
        symbol[rows, i] = merged
        symbol[rows, j] = -1
        following[rows, i] = after
        previous[rows, after] = i
        changed = (
            (j, PairTable.NONE),
            (i, table.leaves(merged, symbol[rows, after], i, shift)),
            (before, table.leaves(symbol[rows, before], merged, before, shift)),
        )
        for leaf, value in changed:
            tree[rows, size + leaf] = value
        for leaf, _ in changed:
            node = (size + leaf) >> 1
            while node[0]:  # all leaves are on one level
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node >>= 1
    keep = (symbol >= 0) & (symbol != PairTable.OUTSIDE)
    return symbol[keep], keep.sum(axis=1)


class WordBpe:
    """A byte-level BPE vocabulary with word ends, from the text of its JSON file."""

    #: The expressions that cut normalised text into words, as the file states them.
    _KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if steps[0]["pattern"]["Regex"] != self._KNOWN_SPLIT or spec["decoder"] is not None:
            raise ValueError("unknown kind of vocabulary file")
        suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()
        self.first = [vocab[c] for c in alphabet]
        self.last = [vocab[c + suffix] for c in alphabet]
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.tokens: dict[int, str] = {i: t for t, i in vocab.items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        self.cut_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        self.words = word_pattern()
        self.table = PairTable(self.pairs)
        # ids of words and of runs without spaces, in two generations: what is met again stays
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _symbols(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        symbols = [self.first[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        return symbols

    def word_ids(self, word: str) -> list[int]:
        return merge_symbols(self._symbols(word), self.pairs)

    def _recall(self, text: str) -> bytes | None:
        packed = self.memo.get(text)
        if packed is None:
            packed = self.older.get(text)
            if packed is not None:
                self._remember(text, packed)
        return packed

    def _remember(self, text: str, packed: bytes) -> None:
        if len(text) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_WORDS:
                self.older, self.memo = self.memo, {}
            self.memo[text] = packed

    def forget(self) -> None:
        self.memo, self.older = {}, {}

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Packed ids of each word, little-endian 32-bit integers; the words are distinct."""
        out: dict[str, bytes] = {}
        by_size: dict[int, list[tuple[str, list[int]]]] = {}
        for word in words:
            symbols = self._symbols(word)
            if len(symbols) > BATCH_SYMBOLS:
                out[word] = array("I", merge_symbols(symbols, self.pairs)).tobytes()
            else:
                by_size.setdefault((len(symbols) + 1).bit_length(), []).append((word, symbols))
        for size, group in by_size.items():
            step = max(1, BATCH_LEAVES >> size)
            for at in range(0, len(group), step):
                part = group[at : at + step]
                merged, counts = merge_batch([s for _, s in part], self.table)
                packed = merged.astype("<u4").tobytes()
                begin = 0
                for (word, _), end in zip(part, (4 * np.cumsum(counts)).tolist()):
                    out[word] = packed[begin:end]
                    begin = end
        return out

    def _normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower-cased without regard to its place in the word
                text = text.replace("Σ", "σ")
        return text.lower()

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts without special tokens."""
        runs = [self._normal(t).split(" ") for t in texts]
        known: dict[str, bytes] = {}
        new: dict[str, list[str]] = {}
        recall = self.memo.get
        for run in set(chain.from_iterable(runs)):
            packed = recall(run)
            if packed is None:
                packed = self._recall(run)
            if packed is None:
                new[run] = self.words.findall(run)
            else:
                known[run] = packed
        ids: dict[str, bytes] = {}
        missing: list[str] = []
        for word in set(chain.from_iterable(new.values())):
            packed = known.get(word)
            if packed is None:
                packed = self._recall(word)
            if packed is None:
                missing.append(word)
            else:
                ids[word] = packed
        encoded = self._encode_words(missing)
        ids.update(encoded)
        for run, words in new.items():
            packed = known[run] = b"".join([ids[w] for w in words])
            self._remember(run, packed)
        for word, packed in encoded.items():
            self._remember(word, packed)
        return [b"".join([known[r] for r in run]) for run in runs]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` of each text, their new words encoded together."""
        out = [b""] * len(texts)
        plain = [k for k, t in enumerate(texts) if t and "<|" not in t]
        for at in range(0, len(plain), BATCH_TEXTS):
            part = plain[at : at + BATCH_TEXTS]
            for k, packed in zip(part, self._plain([texts[k] for k in part])):
                out[k] = packed
        for k, text in enumerate(texts):
            if text and "<|" in text:
                out[k] = self.encode(text)
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; none for a null or empty text."""
        if not text:
            return b""
        parts = self.cut_special.split(text)
        plain = iter(self._plain(parts[::2]))
        return b"".join(
            array("I", [self.special[p]]).tobytes() if k % 2 else next(plain) for k, p in enumerate(parts)
        )

    def decode(self, ids: bytes) -> str:
        """The tokens' strings with a space between; ids outside the vocabulary are left out."""
        return " ".join([t for t in map(self.tokens.get, array("I", ids)) if t is not None])


@lru_cache(maxsize=2)
def _loaded(text: str) -> WordBpe:
    return WordBpe(text)


def default_vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _vocabulary(docs: DataFrame, path: str | None):
    with open(path or default_vocabulary_path(), encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _encoded(docs: DataFrame, id_col: str, text_col: str, vocabulary, row, columns: str) -> DataFrame:
    """``doc_id`` and ``row(vocabulary, packed ids)`` of every row."""
    schema = f"doc_id long, {columns}"
    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary.value)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_TEXTS):
                    part = batch.slice(at, BATCH_TEXTS)
                    ids = bpe.encode_all(part.column(1).to_pylist())
                    values = zip(*[row(bpe, packed) for packed in ids])
                    arrays = [pa.array(v, type=f.type) for v, f in zip(values, list(out_schema)[1:])]
                    yield pa.RecordBatch.from_arrays([part.column(0), *arrays], schema=out_schema)
        finally:
            bpe.forget()  # the worker goes on to other tasks

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(source, run, schema)


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_path: str | None = None,
) -> DataFrame:
    """``(doc_id, ids array<int>, decoded)`` of every row (null text: no ids, empty string).

    Repeated rows and null ids are kept as rows. Other columns are ignored.
    """
    vocabulary = _vocabulary(docs, vocabulary_path)

    def row(bpe: WordBpe, ids: bytes) -> tuple:
        return array("I", ids).tolist(), bpe.decode(ids)

    return _encoded(docs, id_col, text_col, vocabulary, row, "ids array<int>, decoded string")


def bpe_digest(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_path: str | None = None,
) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every row."""
    vocabulary = _vocabulary(docs, vocabulary_path)

    def row(bpe: WordBpe, ids: bytes) -> tuple:
        decoded = bpe.decode(ids).encode("utf-8")
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return _encoded(
        docs, id_col, text_col, vocabulary, row, "n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
