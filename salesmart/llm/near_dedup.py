"""Near duplicates: one-permutation MinHash, banded buckets, star-shaped candidate edges.

A document's set holds the hashes of its distinct word shingles. One hash
function serves the whole signature: hash space is cut into ``BANDS * ROWS``
bins, a bin's value is the least hash in it, and an empty bin takes the value of
the first filled bin in an order of its own (optimal densification). Documents
that agree on all rows of a band share a bucket.

1. Equal sets form one class; only classes go on.
2. In every bucket of two classes or more, the most central member (the one
   with the most bucket mates overall) is the hub, and every other member has
   one edge, to the hub. Edges are linear in bucket members, however large a
   bucket is.
3. Edges are confirmed on the full sets, and linked classes form components.
4. A member that its hub did not confirm may still be linked to another member
   of the hub's star. Such members, and only they, are compared with the rest
   of the star, in blocks of sets spread over the cluster; nothing but confirmed
   links comes out. Stars whose members are all confirmed cost nothing here.

The first two of these steps shuffle 64-bit hashes only. Sets are rebuilt from
the texts of documents that have an edge.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_batches, plainly_named
from salesmart.llm.components import connected_components
from salesmart.session import scratch_uri

BANDS = 32
ROWS = 6
SHINGLE_WORDS = 3
PERCENT = 85
#: Bounds of one block of sets: how many, and their shingles in all (a larger single set is a block).
BLOCK_SETS = 256
BLOCK_SHINGLES = 250_000
MEMO_WORDS = 300_000
#: How many documents' results a Python worker holds before it hands them on.
BATCH_ROWS = 500

_C = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=16)
def _odd_factors(count: int) -> np.ndarray:
    """Odd multipliers, one for each place in a sequence of hashes."""
    return mix64(np.arange(1, count + 1, dtype=np.uint64) * _C[0]) | np.uint64(1)


class WordHashes(dict):
    """Word to 64-bit hash, computed once for each word it holds."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        self[word] = value
        return value


def word_hashes(text: str, memo: WordHashes) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased."""
    words = text.encode("utf-8", "replace").lower().split()
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_set(text: str | None, memo: WordHashes, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than ``k``: the whole sequence as one shingle."""
    if not text:
        return np.empty(0, np.uint64)
    h = word_hashes(text, memo)
    n = min(k, len(h))
    if n == 0:
        return h
    factors = _odd_factors(n + 1)
    acc = np.full(len(h) - n + 1, factors[n], dtype=np.uint64)
    for j in range(n):
        acc += h[j : len(h) - n + 1 + j] * factors[j]
    return np.unique(mix64(acc))


@lru_cache(maxsize=4)
def _bins(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds of the bins, and for each bin the rank of every bin as its donor."""
    bounds = np.array([(i << 64) // count for i in range(count)], dtype=np.uint64)
    pairs = np.arange(count * count, dtype=np.uint64).reshape(count, count)
    order = np.argsort(mix64(pairs * _C[2] + _C[3]), axis=1)
    return bounds, np.argsort(order, axis=1).astype(np.int32)


def signature(shingles: np.ndarray, bins: int = BANDS * ROWS) -> np.ndarray:
    """The densified one-permutation MinHash of a non-empty set."""
    bounds, donor_rank = _bins(bins)
    first = np.searchsorted(shingles, bounds)
    filled = first < np.append(first[1:], len(shingles))
    values = shingles[np.minimum(first, len(shingles) - 1)]
    if not filled.all():
        empty, donors = np.flatnonzero(~filled), np.flatnonzero(filled)
        pick = donor_rank[np.ix_(empty, donors)].argmin(axis=1)
        values[empty] = values[donors[pick]]
    return values


def band_keys(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket key for each band."""
    table = values.reshape(bands, rows) * _odd_factors(rows)
    return mix64(table.sum(axis=1, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _C[4])


def set_key(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


SIGNATURES = "doc_id long, n_shingles long, set_key long, bands array<long>"


def signatures(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``SIGNATURES`` for every row of ``docs (doc_id, text)``; no words: key null, no bands."""

    def run(batches):
        memo = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                sizes, keys, bands = [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle_set(text, memo, k)
                    sizes.append(len(s))
                    keys.append(set_key(s) if len(s) else None)
                    bands.append(band_keys(signature(s)).view(np.int64) if len(s) else ())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands"],
                )

    return map_batches(docs, run, SIGNATURES)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """``(node, shingles binary)`` for every row of ``docs (doc_id, text)`` that has words."""

    def run(batches):
        memo = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                sets = [
                    s
                    for text in batch.slice(at, 200).column(1).to_pylist()
                    if len(s := shingle_set(text, memo, k))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(map(set_key, sets), pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["node", "shingles"],
                )

    return map_batches(docs, run, "node long, shingles binary")


def _alike(shared, n_a, n_b, percent: int):
    return 100 * shared >= percent * (n_a + n_b - shared)


def _confirm(pairs: DataFrame, percent: int) -> DataFrame:
    """``pairs (a, b, set_a, set_b)`` to ``(a, b, alike boolean)`` on the full sets."""

    def run(batches):
        for batch in batches:
            sides = [
                [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(c)]
                for c in ("set_a", "set_b")
            ]
            alike = [
                bool(_alike(np.intersect1d(x, y, assume_unique=True).size, len(x), len(y), percent))
                for x, y in zip(*sides)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(alike, pa.bool_())],
                names=["a", "b", "alike"],
            )

    return map_batches(pairs, run, "a long, b long, alike boolean")


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, its lineage cut."""
    spark = df.sparkSession
    path = scratch_uri(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stars(members: DataFrame) -> DataFrame:
    """``members (bucket, node, n, mates)`` to distinct ``(a, n, b, n_b)``: member and hub of a shared bucket."""
    central = members.groupBy("node").agg(F.sum("mates").alias("central"))
    hubs = (
        members.join(central, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("central", "node", "n")).alias("hub"))
        .select("bucket", F.col("hub.node").alias("b"), F.col("hub.n").alias("n_b"))
    )
    return (
        members.join(hubs, "bucket")
        .where(F.col("node") != F.col("b"))
        .select(F.col("node").alias("a"), "n", "b", "n_b")
        .distinct()
    )


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set."""

    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (x, x_row), (y, y_row) = flat(left), flat(right)
    both = np.intersect1d(x, y)
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(both), 8192):
        part = both[at : at + 8192]
        sides = []
        for values, rows, count in ((x, x_row, len(left)), (y, y_row, len(right))):
            place = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[place] == values
            table = np.zeros((count, len(part)), np.float32)
            table[rows[hit], place[hit]] = 1
            sides.append(table)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _forest(alike: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what the true cells of ``alike`` join, at most one for each row and column."""
    big = np.iinfo(np.int64).max
    rows = np.where(alike.any(axis=1), left, big)
    columns = np.where(alike.any(axis=0), right, big)
    while True:
        down = np.minimum(columns, np.where(alike, rows[:, None], big).min(axis=0, initial=big))
        across = np.minimum(rows, np.where(alike, down[None, :], big).min(axis=1, initial=big))
        if (down == columns).all() and (across == rows).all():
            break
        rows, columns = across, down
    pairs = [*zip(left.tolist(), rows.tolist()), *zip(right.tolist(), columns.tolist())]
    return [(a, b) for a, b in pairs if b != big and a != b]


def _block_links(pairs: DataFrame, percent: int) -> DataFrame:
    """``pairs (u, s)`` of blocks ``array<struct<a, shingles>>`` to links that connect what is alike."""

    def side(block: list[dict]) -> tuple[np.ndarray, list[np.ndarray]]:
        return (
            np.array([x["a"] for x in block], np.int64),
            [np.frombuffer(x["shingles"], np.uint64) for x in block],
        )

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                (u, u_sets), (s, s_sets) = (side(batch.column(c)[k].as_py()) for c in ("u", "s"))
                shared = _shared_counts(u_sets, s_sets)
                sizes = [np.array([len(x) for x in y]) for y in (u_sets, s_sets)]
                alike = _alike(shared, sizes[0][:, None], sizes[1][None, :], percent)
                alike &= u[:, None] != s[None, :]
                links = _forest(alike, u, s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[j] for x in links], pa.int64()) for j in (0, 1)], names=["a", "b"]
                )

    return map_batches(pairs, run, "a long, b long")


def _open_star_links(stars: DataFrame, checked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one star of which the hub did not confirm at least one."""
    members = stars.join(checked, ["a", "b"], "left").select(
        "a", "b", "n", F.coalesce("alike", F.lit(False)).alias("confirmed")
    )
    hubs = (
        members.groupBy("b")
        .agg(
            F.greatest(
                F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)
            ).alias("blocks"),
            F.count("*").alias("size"),
            F.count_if(~F.col("confirmed")).alias("open"),
        )
        .where("open > 0 and size > 1")
    )
    placed = _written(
        members.join(hubs, "b").select(
            "a", "b", "confirmed", F.expr("pmod(xxhash64(a), blocks)").alias("block")
        ),
        "open-stars",
    )

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        return (
            rows.join(sets, rows.a == sets.node)
            .groupBy("b", "block")
            .agg(F.collect_list(F.struct("a", "shingles")).alias(name))
            .select("b", name)
        )

    return _block_links(
        blocks(placed.where(~F.col("confirmed")), "u").join(blocks(placed, "s"), "b").select("u", "s"),
        percent,
    )


def class_links(
    docs: DataFrame, classes: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Links ``(a, b)`` that join all classes ``(set_key, n_shingles, rep, bands)`` found alike."""
    rows = classes.select(
        F.explode("bands").alias("bucket"), F.col("set_key").alias("node"), F.col("n_shingles").alias("n")
    )
    shared = rows.groupBy("bucket").agg(F.count("*").alias("mates")).where("mates > 1")
    members = _written(rows.join(shared, "bucket").select("bucket", "node", "n", "mates"), "bucket-members")
    stars = _written(_stars(members), "stars")
    edges = stars.where(F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent).select("a", "b")
    nodes = stars.select(F.col("a").alias("set_key")).union(stars.select("b")).distinct()
    wanted = classes.join(nodes, "set_key", "left_semi")
    texts = docs.join(
        _written(wanted.select(F.col("rep").alias("doc_id")), "candidate-ids"), "doc_id", "left_semi"
    )
    sets = _written(
        _sets(texts.select("doc_id", "text"), k).groupBy("node").agg(F.first("shingles").alias("shingles")),
        "candidate-sets",
    )
    checked = _written(_confirm(_with_sets(edges, sets), percent), "checked-edges")
    more = _open_star_links(stars, checked, sets, percent)
    return _written(checked.where("alike").select("a", "b").union(more), "links")


RESULT = "doc_id long, n_shingles long, component_id long, kept boolean"


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row for each input row: ``RESULT``.

    ``component_id`` is the smallest doc_id reachable over links (its own if
    none), ``kept`` whether the row's id is that one. Rows without words are
    linked with nothing and kept. A row with a null id is linked with nothing:
    component null, kept. Repeated rows are equal documents: they share their
    component, and each row of the smallest id is kept. Other columns are
    ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = _written(signatures(source, k), "signatures")
    classes = _written(
        sig.where("set_key is not null and doc_id is not null")
        .groupBy("set_key", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")),
        "classes",
    )
    links = class_links(source, classes, k, percent)
    roots = connected_components(links)
    reps = classes.select("set_key", "rep")
    linked = roots.join(reps, roots.node == reps.set_key).select("set_key", "root", "rep")
    least = linked.groupBy("root").agg(F.min("rep").alias("component"))
    joined = linked.join(least, "root").select("set_key", "component")
    # written, so that the join with it below is a plain one whose hot keys can be split
    labels = _written(
        reps.join(joined, "set_key", "left").select(
            "set_key", F.coalesce("component", "rep").alias("component_id")
        ),
        "labels",
    )
    return (
        sig.select("doc_id", "n_shingles", "set_key")
        .join(labels, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNull(), F.lit(None).cast("long"))
            .otherwise(F.coalesce("component_id", "doc_id"))
            .alias("component_id"),
        )
        .withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        )
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, every column as it was."""
    verdict = near_duplicates(docs, id_col, text_col, k, percent)
    gone = _written(verdict.where(~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct(), "near-copies")
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)


def drop_near_duplicate_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row of each near-duplicate group, every column as it was; rows without words stay.

    It is the row with the smallest id, a null id after all others, one row of
    a repeated id. Rows are written once with a number of their own, which is
    their key: ids need be neither present nor distinct, columns may have any
    names. Texts are shuffled only if the rows to drop are too many to broadcast.
    """
    plain = plainly_named(docs)
    text, doc_id = (f"c{docs.columns.index(c)}" for c in (text_col, id_col))
    rows = _written(plain.withColumn("row", F.monotonically_increasing_id()), "rows")
    texts = rows.select(F.col("row").alias("doc_id"), F.col(text).alias("text"))
    verdict = near_duplicates(texts, k=k, percent=percent).select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select("row", F.col(doc_id).alias("id"))
    first = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    best = verdict.join(ids, "row").groupBy("component_id").agg(F.min(first).alias("first"))
    gone = _written(ids.select("row").join(best.select("first.row"), "row", "left_anti"), "near-copies")
    return rows.join(gone, "row", "left_anti").select(*plain.columns).toDF(*docs.columns)
