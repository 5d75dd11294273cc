"""Keep-first de-duplication with rejects kept.

``_duplicate_rank`` is the row number over the transaction id in source
order, as BIGINT: the first copy gets 1, later copies > 1 and are rejected
as duplicates. The rank is computed before any validity rule, so an
invalid first copy still makes the later copies duplicates.

Hot keys. A plain window puts every copy of one id in one task; one id
(NULL ids form one group) may hold a large share of all lines. With a
``SkewPolicy`` the rank is a prefix count over range partitions:

1. The key and order columns alone are range-partitioned on (key, order),
   so a key of any size is cut by its own order, and every line gets its
   number within (partition, key). This table is written once: partition
   borders are sampled, so counts and numbers must come from one run.
2. A key that goes on in a later partition is the last key of the earlier
   one. The first and last key of every partition, with the last one's line
   count, are added up by key into one offset a partition: a table of at
   most one row for each range partition, which is broadcast.
3. rank = number in the partition + the partition's offset, for its first
   key. Lines of rank 2 and more are joined back to the wide lines on (key,
   order), which names a line, so that join has no hot key; all others have
   rank 1. Spark broadcasts the later copies when they are few, and then
   the wide lines are not shuffled at all.

Work is linear (a sort within each partition) in the lines of a key.

``rank_split`` does this for the few heavy ids alone, found by a sketch, and
ranks all others by a plain window: one shuffle of the lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from salesmart.operators.enrich import heavy_keys
from salesmart.operators.normalize import SOURCE_ROW_ID
from salesmart.session import scratch_uri

DUPLICATE_RANK = "_duplicate_rank"
TRANSACTION_KEY = "transaction_id"


@dataclass(frozen=True)
class SkewPolicy:
    """How the key columns are range-partitioned for ranking.

    ``rows_per_cut``: lines of a range partition, on average (None: as many
    partitions as the session shuffles to). ``workspace``: the folder of the
    table of numbered keys (None: a fresh one under the shared scratch).
    """

    rows_per_cut: int | None = None
    workspace: str | None = None


DEFAULT_SKEW = SkewPolicy()


def _order(order_by: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order_by]


def _plain_rank(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*_order(order_by))
    return df.withColumn(DUPLICATE_RANK, F.row_number().over(window).cast("long"))


def _ordered(place: Column, window: WindowSpec, key: str, order_by: Sequence[str], value: Column) -> Column:
    """``value``; two lines of one key with equal ``place`` fail the job."""
    return F.when(
        F.lag(place).over(window).eqNullSafe(place),
        F.raise_error(F.lit(f"{list(order_by)} does not order the lines of one {key}")).cast("int"),
    ).otherwise(value)


def numbered_keys(lines: DataFrame, key: str, order_by: Sequence[str], policy: SkewPolicy) -> DataFrame:
    """``(key, *order_by, _part, _local)``: each line's range partition and its number there, written.

    Two lines with equal key and order cannot be told apart and fail the job.
    """
    columns = [*_order([key]), *_order(order_by)]
    if policy.rows_per_cut:
        parts = max(1, -(-lines.count() // policy.rows_per_cut))
        ranged = lines.repartitionByRange(parts, *columns)
    else:
        ranged = lines.repartitionByRange(*columns)
    place = F.struct(*order_by)
    here = Window.partitionBy("_part", key).orderBy(*_order(order_by))
    number = _ordered(place, here, key, order_by, F.row_number().over(here))
    numbered = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_local", number)
    path = policy.workspace or scratch_uri(lines.sparkSession, "numbered-keys")
    numbered.write.mode("overwrite").parquet(path)
    return lines.sparkSession.read.schema(numbered.schema).parquet(path)


def partition_offsets(numbered: DataFrame, key: str) -> DataFrame:
    """``(_opart, _first, _offset)``: lines of a partition's first key that earlier partitions hold.

    At most one row for each range partition.
    """
    whole_key = F.struct(F.col(key).alias("key"))
    ends = numbered.groupBy("_part").agg(
        F.min(whole_key).alias("first"), F.max(F.struct(whole_key.alias("key"), "_local")).alias("last")
    )
    # an end counts for later partitions that begin with its key; a beginning asks for the sum
    events = F.array(
        F.struct(F.col("first").alias("key"), F.lit(0).alias("n"), F.lit(True).alias("asks")),
        F.struct(F.col("last.key").alias("key"), F.col("last._local").alias("n"), F.lit(False).alias("asks")),
    )
    events = ends.select("_part", F.explode(events).alias("e")).select("_part", "e.*")
    earlier = Window.partitionBy("key").orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    sums = events.withColumn("_offset", F.sum("n").over(earlier))
    return sums.where(F.col("asks") & (F.col("_offset") > 0)).select(
        F.col("_part").alias("_opart"), F.col("key").alias("_first"), "_offset"
    )


def later_copies(lines: DataFrame, key: str, order_by: Sequence[str], policy: SkewPolicy) -> DataFrame:
    """``(key, *order_by, rank)`` of every line but the first of its key."""
    numbered = numbered_keys(lines, key, order_by, policy)
    offsets = partition_offsets(numbered, key)
    of_first_key = (F.col("_part") == F.col("_opart")) & (F.struct(F.col(key).alias("key")) == F.col("_first"))
    rank = F.col("_local").cast("long") + F.coalesce(F.col("_offset"), F.lit(0))
    ranked = numbered.join(F.broadcast(offsets), of_first_key, "left")  # one row a range partition
    return ranked.select(key, *order_by, rank.alias(DUPLICATE_RANK)).where(F.col(DUPLICATE_RANK) > 1)


def rank_duplicates(
    df: DataFrame,
    key: str = TRANSACTION_KEY,
    order_by: Sequence[str] = (SOURCE_ROW_ID,),
    skew: SkewPolicy | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Add ``_duplicate_rank`` (1 = first copy in source order).

    ``order_by`` must be a total order inside a key so the rank is
    deterministic under re-execution, and must be persisted values when
    ``skew`` is given (the plan reads them more than once). NULL keys form
    one group (all but the first NULL-key row are duplicates). ``lines``
    holds the same key and order columns as ``df`` (default: ``df``): a
    pruned scan spares evaluating the lines' joins for the ranks.
    """
    order_by = list(order_by)
    if skew is None:
        return _plain_rank(df, key, order_by)
    lines = (df if lines is None else lines).select(key, *order_by)
    copies = later_copies(lines, key, order_by, skew)
    names = {c: f"_copy_{i}" for i, c in enumerate([key, *order_by])}
    copies = copies.withColumnsRenamed({**names, DUPLICATE_RANK: "_copy_rank"})
    same_line = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    ranked = df.join(copies, same_line, "left")
    rank = F.coalesce(F.col("_copy_rank"), F.lit(1).cast("long"))
    return ranked.withColumn(DUPLICATE_RANK, rank).drop("_copy_rank", *names.values())


def rank_split(
    df: DataFrame, key: str = TRANSACTION_KEY, order_by: Sequence[str] = (SOURCE_ROW_ID,), skew: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    """``rank_duplicates`` with the prefix count for heavy keys (and NULL) alone, a plain window for the others.

    A key that the sketch leaves to the window has a small share of the lines
    (``HEAVY_SHARE``), as any task has. Same ranks, and the same failure on two
    lines of equal key and order.
    """
    order_by = list(order_by)
    spark = df.sparkSession
    path = scratch_uri(spark, "heavy-keys")
    heavy_keys(df, key).write.mode("overwrite").parquet(path)  # at most HEAVY_KEYS rows
    heavy = F.broadcast(spark.read.schema(f"_heavy {df.schema[key].dataType.simpleString()}").parquet(path))
    marked = df.join(heavy, F.col(key) == F.col("_heavy"), "left")
    apart = F.col(key).isNull() | F.col("_heavy").isNotNull()
    window = Window.partitionBy(key).orderBy(*_order(order_by))
    place = F.struct(*order_by)
    rank = _ordered(place, window, key, order_by, F.row_number().over(window)).cast("long")
    light = marked.where(~apart).drop("_heavy").withColumn(DUPLICATE_RANK, rank)
    light = light.where(F.col(DUPLICATE_RANK).isNotNull())  # always; the order is checked even if no one reads the rank
    return light.unionByName(rank_duplicates(marked.where(apart).drop("_heavy"), key, order_by, skew))
