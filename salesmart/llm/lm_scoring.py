"""Deleted interpolation: word bigram and unigram estimates mixed by context-frequency buckets.

    P(w | h) = L2[b] * c(h w) / c(h)  +  L1[b] * c(w) / N  +  L0[b] / (V + 1)

``b`` is the bucket of the context's count (0, 1, 2-3, 4-7, ...). The weights
of a bucket are learned by expectation-maximisation on held-out counts: every
training token is held out in turn, that is, its own occurrence is deleted from
the counts before its estimates are formed. The context of a text's first token
is the end token.

How it scales. Counts are exact and cover every token. Documents are packed into
chunks (about ``CHUNK_BYTES`` of text) of token numbers over the chunk's own
sorted vocabulary. A chunk sends each distinct key (unigram or bigram hash) once
to the key's range, with its training count; the range adds up all chunks and
answers with the totals in the order asked, so answers need no keys. Each range
and each chunk is a bounded task, a very common word or bigram is one entry of
each chunk, and keys cross the network once, delta-packed. What reaches the
driver is N, V and a histogram of quantised estimates for the weights, whose
size is bounded by its grid (``GRID`` cells an octave), not by the corpus.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_batches, ship_package
from salesmart.llm.near_dedup import WordHashes, mix64, word_hashes
from salesmart.session import scratch_uri

FOLDS = 5
HELD_OUT_FOLD = 1
CHUNK_BYTES = 10_000_000
#: Training and scoring tokens for one range of keys.
RANGE_TOKENS = 2_000_000
MIN_RANGES = 64
GRID = 2
EM_ROUNDS = 60

_END = np.uint64(0x5851F42D4C957F2C)
_C0, _C1 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ONE = np.uint64(1)


def is_held_out(doc_id: int | None) -> bool:
    """By the CRC-32 of the id as text; a null id is never held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT_FOLD


# --- packing


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit integers as differences of one common byte width."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0))
    rest = steps[1:]
    width = max(1, (int(rest.max()).bit_length() + 7) // 8) if len(rest) else 1
    body = np.ascontiguousarray(rest).view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + steps[:1].tobytes() + body.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    width = blob[0]
    raw = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(raw) + 1, 8), np.uint8)
    steps[1:, :width] = raw
    steps[0] = np.frombuffer(blob, np.uint8, count=8, offset=1)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Non-negative integers in their common byte width, compressed."""
    top = int(counts.max()) if len(counts) else 0
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max)
    body = np.ascontiguousarray(counts.astype(kind)).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
    planes = np.ascontiguousarray(body.T).tobytes()  # low bytes together, high bytes together
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack_counts(blob: bytes) -> np.ndarray:
    size = blob[0]
    raw = zstandard.ZstdDecompressor().decompress(blob[1:])
    body = np.frombuffer(raw, np.uint8).reshape(size, -1).T
    return np.ascontiguousarray(body).view(np.dtype(f"<u{size}")).ravel().astype(np.int64)


# --- chunks

CHUNK = (
    "chunk long, n_tokens long, ids binary, no_id binary, held_out binary, lengths binary, "
    "vocabulary binary, tokens binary"
)
_CHUNK_TYPES = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
_CHUNK_NAMES = ["chunk", "n_tokens", "ids", "no_id", "held_out", "lengths", "vocabulary", "tokens"]


def _pack_chunk(chunk: int, ids: list, hashes: list[np.ndarray]) -> pa.RecordBatch:
    vocabulary, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
    row = (
        chunk,
        len(tokens),
        np.array([x or 0 for x in ids], np.int64).tobytes(),
        np.array([x is None for x in ids], np.bool_).tobytes(),
        np.array([is_held_out(x) for x in ids], np.bool_).tobytes(),
        np.array([len(h) for h in hashes], np.int64).tobytes(),
        vocabulary.tobytes(),
        pack_counts(tokens),
    )
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(row, _CHUNK_TYPES)], names=_CHUNK_NAMES
    )


def chunks_of(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` packed into ``CHUNK`` rows, each by one task."""

    def run(batches):
        from pyspark import TaskContext

        memo = WordHashes()
        number = TaskContext.get().partitionId() << 32
        ids, hashes, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    h = word_hashes(text, memo) if text else np.empty(0, np.uint64)
                    hashes.append(np.append(h & ~_ONE, _END & ~_ONE))
                    ids.append(doc_id)
                    size += len(text) if text else 0
                    if size >= CHUNK_BYTES:
                        yield _pack_chunk(number, ids, hashes)
                        number, ids, hashes, size = number + 1, [], [], 0
        if ids:
            yield _pack_chunk(number, ids, hashes)

    return map_batches(docs, run, CHUNK)


class Chunk:
    """A chunk's tokens, contexts and bigram keys."""

    def __init__(self, row: dict):
        self.vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        self.tokens = unpack_counts(row["tokens"])
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.held_out = np.frombuffer(row["held_out"], np.bool_)
        self.training = np.repeat(~self.held_out, self.lengths)
        # every text ends with the end token, so the token before is the context throughout
        end = np.searchsorted(self.vocabulary, _END & ~_ONE)
        self.contexts = np.append(end, self.tokens[:-1])
        h = self.vocabulary[self.tokens]
        before = self.vocabulary[self.contexts]
        self.bigrams = mix64(before * _C0 + h * _C1) | _ONE


def _range_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each range of the leading ``bits`` begins in ascending keys."""
    bounds = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(keys, bounds), len(keys))


REQUEST = "range int, chunk long, u_keys binary, u_counts binary, b_keys binary, b_counts binary"


def _requests(chunks: DataFrame, bits: int) -> DataFrame:
    names = ["range", "chunk", "u_keys", "u_counts", "b_keys", "b_counts"]
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                u_counts = np.bincount(c.tokens[c.training], minlength=len(c.vocabulary))
                b_keys = np.unique(c.bigrams)
                seen, n = np.unique(c.bigrams[c.training], return_counts=True)
                c.bigrams = None  # no longer needed
                b_counts = np.zeros(len(b_keys), np.int64)
                b_counts[np.searchsorted(b_keys, seen)] = n
                u_at, b_at = _range_of(c.vocabulary, bits), _range_of(b_keys, bits)
                out = []
                for r in range(1 << bits):
                    u, b = slice(u_at[r], u_at[r + 1]), slice(b_at[r], b_at[r + 1])
                    if u.stop > u.start or b.stop > b.start:
                        out.append(
                            (
                                r,
                                row["chunk"],
                                pack_sorted(c.vocabulary[u]),
                                pack_counts(u_counts[u]),
                                pack_sorted(b_keys[b]),
                                pack_counts(b_counts[b]),
                            )
                        )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*out), types)], names=names
                )

    return map_batches(chunks, run, REQUEST)


ANSWER = "range int, chunk long, u_totals binary, b_totals binary, n_types long, n_tokens long"


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[bytes], int, int]:
    """For each list its keys' totals over all lists; the number of keys counted, and their sum."""
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
    at = np.cumsum([0, *map(len, keys)])
    answers = [pack_counts(total[place[a:b]]) for a, b in zip(at, at[1:])]
    return answers, int((total > 0).sum()), int(total.sum())


def _answers(requests: DataFrame) -> DataFrame:
    def add_up(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        u, types, tokens = _totals(
            [unpack_sorted(r["u_keys"]) for r in rows], [unpack_counts(r["u_counts"]) for r in rows]
        )
        b, _, _ = _totals(
            [unpack_sorted(r["b_keys"]) for r in rows], [unpack_counts(r["b_counts"]) for r in rows]
        )
        rest = [0] * (len(rows) - 1)
        return pa.table(
            {
                "range": pa.array([r["range"] for r in rows], pa.int32()),
                "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                "u_totals": pa.array(u, pa.binary()),
                "b_totals": pa.array(b, pa.binary()),
                "n_types": pa.array([types, *rest], pa.int64()),
                "n_tokens": pa.array([tokens, *rest], pa.int64()),
            }
        )

    return requests.groupBy("range").applyInArrow(add_up, ANSWER)


# --- weights and scores


def _log2_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for no occurrence, else one more than the whole binary logarithm."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def _estimates(c: Chunk, u_totals: np.ndarray, b_totals: np.ndarray):
    """Counts of every token's context, of the token, and of the two together."""
    _, place = np.unique(c.bigrams, return_inverse=True)
    return u_totals[c.contexts], u_totals[c.tokens], b_totals[place]


def _quantised(p: np.ndarray) -> np.ndarray:
    """0 for probability 0, else 1 + steps of 1/GRID octave below 1."""
    out = np.zeros(len(p), np.int64)
    some = p > 0
    out[some] = 1 + np.minimum(np.rint(-GRID * np.log2(p[some])), 32000).astype(np.int64)
    return out


def _cells(c: Chunk, u_totals, b_totals, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Histogram of the training tokens' deleted estimates: packed cells and their counts."""
    context, token, both = (x[c.training] for x in _estimates(c, u_totals, b_totals))
    c.bigrams = None  # no longer needed
    rest = context - 1
    p2 = np.where(rest > 0, (both - 1) / np.maximum(rest, 1), 0.0)
    p1 = (token - 1) / max(n - 1, 1)
    return np.unique(
        _log2_bucket(rest) << 40 | _quantised(p2) << 20 | _quantised(p1), return_counts=True
    )


def learn_weights(cells: np.ndarray, counts: np.ndarray, types: int) -> np.ndarray:
    """Row b: (L2, L1, L0) of bucket b, by expectation-maximisation for each bucket apart.

    A bucket without training tokens takes the next lower one's weights.
    """
    out = np.zeros((65, 3))
    weights = np.array([0.0, 0.0, 1.0]) if not len(cells) else np.array([0.0, 0.5, 0.5])
    buckets = cells >> 40

    def value(q: np.ndarray) -> np.ndarray:
        return np.where(q > 0, np.exp2(-(q - 1) / GRID), 0.0)

    for b in range(len(out)):
        here = buckets == b
        if here.any():
            q, n = cells[here], counts[here].astype(np.float64)
            p = np.stack(
                [value(q >> 20 & 0xFFFFF), value(q & 0xFFFFF), np.full(len(q), 1.0 / (types + 1))], axis=1
            )
            weights = np.array([0.4, 0.4, 0.2])
            for _ in range(EM_ROUNDS):
                share = p * weights
                share /= share.sum(axis=1, keepdims=True)
                weights = (share * n[:, None]).sum(axis=0) / n.sum()
            weights = np.maximum(weights, [0.0, 1e-6, 1e-6])
            weights /= weights.sum()
        out[b] = weights
    return out


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def _score_chunk(row: dict, u_totals, b_totals, n: int, types: int, weights: np.ndarray) -> pa.RecordBatch:
    c = Chunk(row)
    context, token, both = _estimates(c, u_totals, b_totals)
    base = np.log10((token + 0.5) / (n + 0.5 * (types + 1)))
    bucket = _log2_bucket(context)
    p = weights[bucket, 0]
    p *= both
    p /= np.maximum(context, 1)
    p += weights[bucket, 1] * token / max(n, 1)
    p += weights[bucket, 2] / (types + 1)
    starts = np.cumsum(c.lengths) - c.lengths  # no text is without a token
    ids = np.frombuffer(row["ids"], np.int64)
    size = len(ids)
    columns = [
        pa.array(ids, pa.int64(), mask=np.frombuffer(row["no_id"], np.bool_)),
        pa.array(c.held_out, pa.bool_()),
        pa.array(c.lengths, pa.int64()),
        pa.array(np.add.reduceat((token > 0).astype(np.int64), starts), pa.int64()),
        pa.array(np.full(size, n), pa.int64()),
        pa.array(np.add.reduceat(base, starts), pa.float64()),
        pa.array(np.add.reduceat(np.log10(p), starts), pa.float64()),
    ]
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _totals_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    answers = sorted(row["answers"], key=lambda x: x["range"])
    return (
        np.concatenate([unpack_counts(x["u_totals"]) for x in answers]),
        np.concatenate([unpack_counts(x["b_totals"]) for x in answers]),
    )


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``SCORES`` of every row: held-out rows (``is_held_out``) are scored, the others also train.

    A null or empty text is one end token. Repeated rows count and are scored
    as often as they come; a null id is carried and trains. Without any
    training row, N and V are 0 and only the last term is left. An empty table
    gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_uri(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    chunks = written(chunks_of(source), "lm-chunks")
    tokens = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    ranges = max(MIN_RANGES, -(-tokens // RANGE_TOKENS))
    bits = math.ceil(math.log2(ranges))
    answers = written(_answers(_requests(chunks, bits)), "lm-answers")
    n, types = answers.agg(
        F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0))
    ).first()
    grouped = answers.groupBy("chunk").agg(
        F.collect_list(F.struct("range", "u_totals", "b_totals")).alias("answers")
    )
    resolved = chunks.join(grouped, "chunk")

    def histogram(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cells, counts = _cells(Chunk(row), *_totals_of(row), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells, pa.int64()), pa.array(counts, pa.int64())], names=["cell", "n"]
                )

    cells = (
        map_batches(resolved, histogram, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    )
    weights = learn_weights(
        cells.column("cell").to_numpy().astype(np.int64), cells.column("n").to_numpy(), types
    )

    def score(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _score_chunk(row, *_totals_of(row), n, types, weights)

    return map_batches(resolved, score, SCORES)
