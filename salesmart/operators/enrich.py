"""Star enrichment: left equi-joins of the sales lines with the dimensions.

Left joins keep every line; a line without a match gets NULL attributes,
which the quality rules read as an unknown product / store / date. The
physical strategy is Spark's: a dimension is broadcast when its size is
under ``spark.sql.autoBroadcastJoinThreshold`` (estimated statically, or
measured at runtime by AQE), otherwise both sides are shuffled on the key.
Up to ``BROADCAST_STORES`` stores are broadcast in any case: the enriched lines
are the widest rows, and a shuffle of them for the stores the most costly one.
When the accepted rows alone are needed, the accept filter lets Catalyst
turn these joins into inner joins.

Dimensions beyond the broadcast size: lines of one key (a blank product, an
``UNKNOWN_STORE``, a best seller) would all go to one task. With
``split_heavy`` heavy keys are found first, by a frequent-items sketch over a
pruned scan of the key column, and their lines are dealt over ``SALTS`` tasks;
the dimension rows of these few keys are repeated as often. The sketch only
decides how lines are dealt out, so the result does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stores that are broadcast whatever Spark's threshold: some 200 bytes each, 100 MB in all.
BROADCAST_STORES = 500_000
#: Tasks that a heavy key's lines are dealt over.
SALTS = 32
#: Keys that the sketch reports, and counters that it keeps for them.
HEAVY_KEYS = 64
SKETCH_ITEMS = 4096
#: A key is heavy from this share of the lines on.
HEAVY_SHARE = 1 / 128


def heavy_keys(lines: DataFrame, key: str) -> DataFrame:
    """``(_heavy)``: at most ``HEAVY_KEYS`` keys with ``HEAVY_SHARE`` of the lines or more, by estimate."""
    sketch = F.expr(f"approx_top_k({key}, {HEAVY_KEYS}, {SKETCH_ITEMS})")
    seen = lines.select(key).agg(sketch.alias("top"), F.count(F.lit(1)).alias("n"))
    items = seen.select(F.explode("top").alias("x"), "n")
    return items.where(
        F.col("x.item").isNotNull() & (F.col("x.count") >= HEAVY_SHARE * F.col("n"))
    ).select(F.col("x.item").alias("_heavy"))


def _left_join(lines: DataFrame, dimension: DataFrame, key: str, split_heavy: bool) -> DataFrame:
    """``lines`` left join ``dimension`` using ``key``."""
    if not split_heavy:
        return lines.join(dimension, on=key, how="left")
    heavy = F.broadcast(heavy_keys(lines, key))  # at most HEAVY_KEYS rows
    # by content, so that a task that runs again deals its lines alike; a NULL key matches nothing
    place = F.pmod(F.xxhash64(*lines.columns), F.lit(SALTS)).cast("int")
    salt = F.when(F.col(key).isNull(), -1 - place).when(F.col("_heavy").isNotNull(), place).otherwise(0)
    dealt = lines.join(heavy, F.col(key) == F.col("_heavy"), "left").withColumn("_salt", salt).drop("_heavy")
    salts = F.when(F.col("_heavy").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = (
        dimension.join(heavy, F.col(key) == F.col("_heavy"), "left")
        .withColumn("_salt", F.explode(salts))
        .drop("_heavy")
    )
    return dealt.join(repeated, on=[key, "_salt"], how="left").drop("_salt")


def few_stores(stores: DataFrame) -> bool:
    """Whether the stores are broadcast whatever Spark's threshold (a pruned count of at most one more)."""
    return stores.select("store_id").limit(BROADCAST_STORES + 1).count() <= BROADCAST_STORES


def join_products(sales: DataFrame, products: DataFrame, split_heavy: bool = False) -> DataFrame:
    return _left_join(sales, products, "product_id", split_heavy)


def join_stores(sales: DataFrame, stores: DataFrame, split_heavy: bool = False) -> DataFrame:
    """Few stores go to the lines, so that these are not moved for them."""
    if not split_heavy and few_stores(stores):
        stores = F.broadcast(stores)
    return _left_join(sales, stores, "store_id", split_heavy)


def join_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Join on ``transaction_date = date`` and drop the calendar's key column.

    A calendar has a row for each day, some ten thousand, and is broadcast.
    """
    joined = sales.join(calendar, sales["transaction_date"] == calendar["date"], how="left")
    return joined.drop(calendar["date"])


def enrich(
    sales: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    split_heavy: bool = False,
    by_month: bool = False,
) -> DataFrame:
    """Sales lines with product, store and calendar attributes.

    Column order: store_id, product_id, the other sales columns, product,
    store and calendar attributes (key first, as ``USING`` joins place it).
    A dimension key that occurs twice fans the matching lines out. Set
    ``split_heavy`` when products or stores exceed the broadcast size.
    ``by_month`` deals the lines out by the month of their day before the
    stores and the calendar widen them (for few stores, see ``few_stores``; the
    calendar, a row a day, is broadcast then, so that the dealing holds).
    """
    return enrich_further(join_products(sales, products, split_heavy), stores, calendar, split_heavy, by_month)


def enrich_further(
    with_products: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    split_heavy: bool = False,
    by_month: bool = False,
) -> DataFrame:
    """``enrich`` from lines that have the attributes of their products on."""
    if by_month:
        dated = with_products.withColumn("_month_start", F.trunc("transaction_date", "MM"))
        with_products = dated.hint("rebalance", F.col("_month_start")).drop("_month_start")
        calendar = F.broadcast(calendar)
    return join_calendar(join_stores(with_products, stores, split_heavy), calendar)
