"""Dataset checks.

Each check returns the offending rows (empty = the check holds), so it
runs distributed and a caller can both count and inspect failures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets in which two datasets are compared.
HASH_BUCKETS = 4096
# Attributes every line of one order must share.
ORDER_LEVEL_COLUMNS = ["transaction_date", "store_id", "channel", "order_status"]


def order_metadata_conflicts(
    sales: DataFrame, key: str = "order_id", shared: Sequence[str] = ORDER_LEVEL_COLUMNS
) -> DataFrame:
    """Orders whose lines disagree on an order-level attribute.

    One row per such order, saying for each attribute whether its lines
    differ; NULL against a value is a difference, as for whole rows. One
    grouped minimum and maximum of a one-field struct (which orders NULL
    like a value): combined before the shuffle, so a very large order is no
    hot spot.
    """
    ends = sales.groupBy(key).agg(
        *[end(F.struct(c)).alias(f"_{name}_{c}") for c in shared for name, end in (("min", F.min), ("max", F.max))]
    )
    differs = ends.select(
        key, *[(~F.col(f"_min_{c}").eqNullSafe(F.col(f"_max_{c}"))).alias(f"{c}_differs") for c in shared]
    )
    return differs.where(F.greatest(*[F.col(f"{c}_differs") for c in shared]))


def order_line_histogram(sales: DataFrame, key: str = "order_id") -> DataFrame:
    """(lines_per_order, order_count): how many orders have n lines."""
    per_order = sales.groupBy(key).agg(F.count(F.lit(1)).alias("lines_per_order"))
    return per_order.groupBy("lines_per_order").agg(F.count(F.lit(1)).alias("order_count"))


def _bucket(row_hash: Column, buckets: int) -> Column:
    """The low bits of a row hash: never NULL, so the optimizer adds no filter on the hash's inputs."""
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("the number of buckets is a power of two")
    return row_hash.bitwiseAND(F.lit(buckets - 1).cast("long"))


def _fingerprints(df: DataFrame, buckets: int) -> DataFrame:
    """By bucket of the row hash: row count and sums of two row hashes, whatever the rows' order."""
    low = F.lit(0xFFFFFFFF)
    rows = df.select(F.xxhash64(*df.columns).alias("h"), F.xxhash64(F.lit(1), *df.columns).alias("g"))
    return rows.groupBy(_bucket(F.col("h"), buckets).alias("_bucket")).agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor("h").alias("xor"),
            F.sum(F.col("g").bitwiseAND(low)).alias("low"),
            F.sum(F.shiftrightunsigned("g", 32)).alias("high"),
        ).alias("print")
    )


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = HASH_BUCKETS) -> DataFrame:
    """``(_bucket)`` of the hash buckets in which the two sides differ: at most ``buckets`` rows.

    ``buckets`` is a power of two.
    """
    a, b = _fingerprints(left, buckets), _fingerprints(right, buckets).withColumnRenamed("print", "other")
    joined = a.join(b, "_bucket", "full")
    return joined.where(~F.col("print").eqNullSafe(F.col("other"))).select("_bucket")


def dataset_differences(left: DataFrame, right: DataFrame, buckets: int = HASH_BUCKETS) -> DataFrame:
    """Rows (with multiplicity) present on one side only; empty when equal.

    First both sides are reduced to a fingerprint for each bucket of the row
    hash, which shuffles at most ``buckets`` small rows a task; only rows of
    buckets whose fingerprints differ are then compared in full. (Unequal
    buckets with equal counts and equal sums of two 64-bit hashes would be
    taken as equal.) There, one grouped sum of +1 (left) and -1 (right) over
    all columns; the result carries a ``side`` column (``left_only`` /
    ``right_only``) before the compared columns, a row for each surplus copy.
    """
    cols = left.columns
    right = right.select(*cols)
    differ = F.broadcast(differing_buckets(left, right, buckets))  # at most ``buckets`` longs
    both = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    row_bucket = _bucket(F.xxhash64(*cols), buckets)
    signed = both.withColumn("_row_bucket", row_bucket).join(differ, F.col("_row_bucket") == F.col("_bucket"))
    surplus = signed.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n != 0")
    side = F.when(F.col("_n") > 0, F.lit("left_only")).otherwise(F.lit("right_only"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n")))
    return surplus.select(side.alias("side"), *cols, copies.alias("_copy")).drop("_copy")
