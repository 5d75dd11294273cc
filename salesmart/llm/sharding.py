"""Hierarchical weighted hash tree: region, rack, shard.

A key descends the tree: at each level every child makes one draw, an
exponential variable from a hash of (key, path of the child) whose rate is the
weight below the child, and the least draw is entered. So shards get rows in
proportion to their weights, and a key makes as many draws as there are children
on its one path, not as there are shards.

A tree grows by layers. What is added later, a shard, a rack or more weight for a
shard, is a layer of its own (``Leaf.layer``): at the top the regions of all
layers draw, each with its weight in that layer, and the rest of the descent
stays inside the layer entered. The draws of the older layers do not change, so a
new layer takes rows only into itself, and taking it away gives them back; no
other row moves. A tree's layers are its history: keep them as they came.

How it scales: the place of a row is an expression over its own key. Slots need
one shuffle of (id, size, checksum, shard), never of texts: rows are numbered
inside hash buckets of a shard, and the offsets of the buckets come from a
count table of ``shards x buckets`` rows, so no shard is one task's work.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import let

SLOT_BUCKETS = 1024


@dataclass(frozen=True)
class Leaf:
    """A shard: its place in the tree, its number and its weight."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0
    layer: int = 0


def balanced_tree(shards: int, regions: int = 2, racks: int = 3, first: int | None = None) -> list[Leaf]:
    """``shards`` equal leaves dealt over ``regions x racks``.

    The ``first`` ones (default: all) are the tree as it was laid out, each later
    one was added to it.
    """
    first = shards if first is None else first
    return [
        Leaf(n % regions, (n // regions) % racks, n, layer=max(0, n - first + 1)) for n in range(shards)
    ]


def _draw(key: Column, path: tuple[int, ...], weight: float) -> Column:
    h = F.xxhash64(key, *map(F.lit, path))
    # 53 high bits to a number in (0, 1): the finest that a double holds exactly
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(u) / F.lit(float(weight))


def _descend(key: Column, leaves: list[Leaf], path: tuple[int, ...], levels: list[Callable[[Leaf], tuple]]) -> Column:
    """The leaf at which a key ends that has come down ``path``; only the branch entered is evaluated."""
    if not levels:
        leaf = leaves[0]
        return F.struct(
            F.lit(leaf.region).alias("region"), F.lit(leaf.rack).alias("rack"), F.lit(leaf.shard).alias("shard")
        )
    children: dict[tuple, list[Leaf]] = {}
    for leaf in leaves:
        children.setdefault(levels[0](leaf), []).append(leaf)
    parts = [(path + step, below) for step, below in sorted(children.items())]
    ends = [_descend(key, below, way, levels[1:]) for way, below in parts]
    if len(parts) == 1:
        return ends[0]
    draws = [
        F.struct(_draw(key, way, sum(x.weight for x in below)).alias("draw"), F.lit(k).alias("child"))
        for k, (way, below) in enumerate(parts)
    ]

    def entered(child: Column) -> Column:
        out = F.when(child == 0, ends[0])
        for k, end in enumerate(ends[1:], 1):
            out = out.when(child == k, end)
        return out

    return let(F.least(*draws)["child"], entered)


def place(key: Column, leaves: list[Leaf]) -> Column:
    """``struct(region, rack, shard)`` at the end of the key's descent.

    A null key hashes like any other value (all null keys go to one shard).
    Leaves of weight 0 or less get nothing.
    """
    some = [x for x in leaves if x.weight > 0 and math.isfinite(x.weight)]
    if not some:
        raise ValueError("the tree has no leaf of positive weight")
    return _descend(
        key, some, (), [lambda x: (x.layer, x.region), lambda x: (x.rack,), lambda x: (x.shard,)]
    )


def shard_rows(
    rows: DataFrame,
    leaves: list[Leaf],
    key_col: str = "doc_id",
    order_cols: tuple[str, ...] = (),
    buckets: int = SLOT_BUCKETS,
) -> DataFrame:
    """``rows`` with ``region, rack, shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    Slots follow (bucket of key and ``order_cols``, key, ``order_cols``); fully equal rows may
    swap slots. Existing columns of these names are replaced.
    """
    spot = rows.withColumn("_place", place(F.col(key_col), leaves)).select(
        *[c for c in rows.columns if c not in ("region", "rack", "shard", "slot")],
        "_place.region",
        "_place.rack",
        "_place.shard",
        F.pmod(F.hash(F.col(key_col), *map(F.col, order_cols)), F.lit(buckets)).alias("_bucket"),
    )
    counts = spot.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy(key_col, *order_cols)
    numbered = spot.withColumn("_rank", F.row_number().over(inside).cast("long") - 1)
    return (
        numbered.join(offsets, ["shard", "_bucket"])
        .withColumn("slot", F.col("_rank") + F.col("_before"))
        .drop("_rank", "_before", "_bucket")
    )


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document's size, checksum, shard, slot and its shard with one more shard.

    ``size`` is the text's UTF-8 bytes plus 8 (null text: 8, checksum 0). The
    law is ``key``: id and shard count decide; the one more shard is a layer added
    to the tree. Repeated rows share a shard and get slots of their own; a null id
    is a key of its own; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = shard_rows(rows, balanced_tree(shards), "doc_id", ("text_crc32", "size"))
    grown = place(F.col("doc_id"), balanced_tree(shards + 1, first=shards))["shard"]
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        grown.alias("grown_shard"),
        "region",
        "rack",
    )
