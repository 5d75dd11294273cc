"""Driver tables -> raw retail tables (the test-data adapter).

The raw sales lines, products, stores and calendar are derived from the
TPC-H-like ``lineitem / orders / part / supplier / nation / region``
tables by the mapping documented in FIXTURES.md section 2: one sales line
per lineitem row, with deterministic defects keyed on the source keys so
that every quality rule fires. The key moduli below only choose which
lines carry a defect value; no line is ever filtered out, so every query
covers the whole tables. Everything is a lazy DataFrame that grows with
the input tables.

Source order: the raw CSV of a real run has a file order (the ingest
``_source_row_id``); these tables have none, so the first copy of a
transaction is decided by the helper columns ``SOURCE_ORDER``, which are
unique within a transaction id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.money import money
from salesmart.operators.calendar import calendar_from_bounds

SOURCE_ORDER = ["_src_partkey", "_src_suppkey", "_src_shipdate"]

# Fixed values of the mapping (FIXTURES.md section 2): the defect moduli
# on the source keys, the cost ratio, the calendar's last published day,
# and the typed constants of the product and store dimensions.
MISSING_PRODUCT_MOD = 97
UNKNOWN_PRODUCT_MOD = 89
UNKNOWN_STORE_MOD = 41
KIOSK_CHANNEL_MOD = 113
NULL_CHANNEL_MOD = 131
ZERO_QUANTITY_MOD = 101
NULL_QUANTITY_MOD = 103
NEGATIVE_PRICE_MOD = 107
NEGATIVE_COST_MOD = 109
REFUNDED_STATUS_MOD = 127
UNIT_COST_RATIO = "0.60"
CALENDAR_LAST_DAY = "2000-12-31"
PRODUCT_LAUNCH_DATE = "1992-01-01"
STORE_TYPE = "supplier_depot"
STORE_OPENED_AT = "1992-01-01"
STORE_POPULATION_SEGMENT = "national"


# Read schemas of the driver tables: only the columns the mapping uses. A
# given schema spares the driver a footer read per table and prunes the
# scan to these columns.
DRIVER_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Money and counts at their full widths; products widen as DECIMAL does and
# results are cast to MONEY.
PRICE = "decimal(18,2)"
RATE = "decimal(4,2)"
COUNT = "decimal(10,0)"


def _unit_cost_small(retail_price: Column) -> Column:
    return F.round(retail_price.cast(PRICE) * F.lit(UNIT_COST_RATIO).cast(RATE), 2)


def _unit_cost(retail_price: Column) -> Column:
    return money(_unit_cost_small(retail_price))


def transaction_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def _source_order() -> list[Column]:
    return [
        F.col("l_partkey").alias("_src_partkey"),
        F.col("l_suppkey").alias("_src_suppkey"),
        F.to_date(F.col("l_shipdate")).alias("_src_shipdate"),
    ]


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sales line on its few source columns, in narrow types: key, source order and amounts.

    Ranking and joining move lines on these; ``raw_sales`` forms the contract columns after them.
    """
    return _read(spark, sf_dir, "lineitem").select(
        transaction_id().alias("transaction_id"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("l_quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("l_extendedprice"),
        "l_discount",
        *_source_order(),
    )


def raw_sales(
    spark: SparkSession,
    sf_dir: str,
    lines: DataFrame | None = None,
    one_each: bool = False,
    arrange: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Raw sales lines: the 15 contract columns plus the source-order helpers.

    ``lines``: ``sales_lines``, by default all; columns added to them are kept, last.
    ``one_each``: a line whose order or part has several rows comes once, with one of them.
    ``arrange`` moves the joined lines on their few source columns, before the contract columns are formed.
    """
    if lines is None:
        lines = sales_lines(spark, sf_dir)
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.substring("o_orderpriority", 1, 1).alias("_priority"),
    )
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    if one_each:
        orders, part = orders.dropDuplicates(["o_orderkey"]), part.dropDuplicates(["p_partkey"])
    known = {"transaction_id", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", *SOURCE_ORDER}
    added = [c for c in lines.columns if c not in known]
    # Left joins: a line whose order or part is missing keeps its row, with NULL values.
    lines = lines.join(part, F.col("_src_partkey") == part.p_partkey, "left").join(
        orders, F.col("l_orderkey") == orders.o_orderkey, "left"
    )
    if arrange is not None:
        lines = arrange(lines.drop("transaction_id", "p_partkey", "o_orderkey"))

    ok, pk, sk = F.col("l_orderkey"), F.col("_src_partkey"), F.col("_src_suppkey")
    status = F.col("o_orderstatus")
    qty = F.col("l_quantity")
    qty_n = qty.cast(COUNT)
    gross_p = F.col("l_extendedprice")
    gross = money(gross_p)
    net0_p = F.round(gross_p * (F.lit(1).cast(RATE) - F.col("l_discount").cast("decimal(4,2)")), 2)
    net0 = money(net0_p)
    uc0_p = _unit_cost_small(F.col("p_retailprice"))
    uc0 = money(uc0_p)
    priority = F.col("_priority")

    return lines.select(
        transaction_id().alias("transaction_id"),  # formed anew: the joins need not move the text
        F.concat(F.lit("O"), ok.cast("string")).alias("order_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.when(pk % MISSING_PRODUCT_MOD == 0, F.lit("   "))
        .when(pk % UNKNOWN_PRODUCT_MOD == 0, F.lit("UNKNOWN_PRODUCT"))
        .otherwise(F.concat(F.lit(" P"), pk.cast("string"), F.lit(" ")))
        .alias("product_id"),
        F.when(sk % UNKNOWN_STORE_MOD == 0, F.lit("UNKNOWN_STORE"))
        .otherwise(F.concat(F.lit("S"), sk.cast("string"), F.lit(" ")))
        .alias("store_id"),
        F.when(ok % KIOSK_CHANNEL_MOD == 0, F.lit("kiosk"))
        .when(ok % NULL_CHANNEL_MOD == 0, F.lit(None).cast("string"))
        .when(priority.isin("1", "2"), F.lit("store"))
        .when(priority == "3", F.lit("online"))
        .when(priority == "4", F.lit("marketplace"))
        .when(priority == "5", F.lit(" ONLINE "))
        .alias("channel"),
        F.when(ok % ZERO_QUANTITY_MOD == 0, F.lit(0))
        .when(ok % NULL_QUANTITY_MOD == 0, F.lit(None).cast("int"))
        .otherwise(qty)
        .alias("quantity"),
        F.when(ok % NEGATIVE_PRICE_MOD == 0, money(F.lit(-99)))
        .otherwise(money(F.col("p_retailprice")))
        .alias("unit_price"),
        money(F.col("l_discount") * F.lit(100)).alias("discount_percent"),
        gross.alias("gross_revenue"),
        F.when(ok % NEGATIVE_PRICE_MOD == 0, money(F.lit(-99)))
        .when(status == "O", money(F.lit(0)))
        .otherwise(net0)
        .alias("net_revenue"),
        F.when(ok % NEGATIVE_COST_MOD == 0, money(F.lit(-1))).otherwise(uc0).alias("unit_cost"),
        money(qty_n * uc0_p).alias("total_cost"),
        F.when(status == "O", money(F.lit(0))).otherwise(money(net0_p - qty_n * uc0_p)).alias("margin"),
        F.when(ok % REFUNDED_STATUS_MOD == 0, F.lit("refunded"))
        .when(status == "F", F.lit("paid"))
        .when(status == "P", F.lit(" PAID"))
        .when(status == "O", F.lit("Cancelled "))
        .alias("order_status"),
        *SOURCE_ORDER,
        *added,
    )


def sales_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction id and source order of every raw sales line: a scan of these columns alone."""
    return _read(spark, sf_dir, "lineitem").select(
        transaction_id().alias("transaction_id"), *_source_order()
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    return part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        money(F.col("p_retailprice")).alias("base_price"),
        _unit_cost(F.col("p_retailprice")).alias("base_cost"),
        F.lit(PRODUCT_LAUNCH_DATE).cast("date").alias("launch_date"),
        F.lit(True).alias("is_active"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Left joins keep every supplier; a missing nation leaves city NULL and
    # the store then counts as unknown, as a NULL attribute does.
    joined = supplier.join(
        nation, supplier.s_nationkey == nation.n_nationkey, "left"
    ).join(region, F.col("n_regionkey") == region.r_regionkey, "left")
    return joined.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("store_id"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.lit(STORE_TYPE).alias("store_type"),
        F.lit(STORE_OPENED_AT).cast("date").alias("opened_at"),
        F.lit(STORE_POPULATION_SEGMENT).alias("population_segment"),
    )


def order_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (start, end): first order day to the calendar's last published day."""
    orders = _read(spark, sf_dir, "orders")
    return orders.agg(F.min(F.to_date("o_orderdate")).alias("start")).select(
        "start", F.lit(CALENDAR_LAST_DAY).cast("date").alias("end")
    )


def order_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (start, end): first to last order day."""
    orders = _read(spark, sf_dir, "orders")
    return orders.agg(
        F.min(F.to_date("o_orderdate")).alias("start"),
        F.max(F.to_date("o_orderdate")).alias("end"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar published from the first order day through CALENDAR_LAST_DAY.

    Orders after that day find no calendar row and are rejected as
    ``missing_calendar_date``.
    """
    return calendar_from_bounds(order_date_bounds(spark, sf_dir))


def raw_tables(spark: SparkSession, sf_dir: str, sales: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four raw tables (``sales``: the raw sales lines, by default as ``raw_sales`` has them)."""
    return {
        "sales_transactions": raw_sales(spark, sf_dir) if sales is None else sales,
        "products": products(spark, sf_dir),
        "stores": stores(spark, sf_dir),
        "calendar": calendar(spark, sf_dir),
    }
