"""Column contracts of the four raw tables.

Raw money columns are ``DOUBLE``, as the source reads them: a sub-cent
amount, NaN or a very large number stays what the file says and meets the
rules as such. Frames with ``DECIMAL`` money (the test-data adapter) are
accepted by every operator as well; types are never forced. Sums are exact
for either (see ``salesmart.functions.money``).
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

#: Money of the test-data adapter and of computed line measures.
MONEY = DecimalType(18, 2)
#: Money as the raw CSV files are read.
RAW_MONEY = DoubleType()

# Table and column names, in file order, as the raw CSV
# files carry them. They must equal the source contract exactly.
SALES_COLUMNS = [
    "transaction_id",
    "order_id",
    "transaction_date",
    "product_id",
    "store_id",
    "channel",
    "quantity",
    "unit_price",
    "discount_percent",
    "gross_revenue",
    "net_revenue",
    "unit_cost",
    "total_cost",
    "margin",
    "order_status",
]
PRODUCT_COLUMNS = [
    "product_id",
    "product_name",
    "category",
    "brand",
    "base_price",
    "base_cost",
    "launch_date",
    "is_active",
]
STORE_COLUMNS = [
    "store_id",
    "city",
    "region",
    "store_type",
    "opened_at",
    "population_segment",
]
CALENDAR_COLUMNS = [
    "date",
    "year",
    "quarter",
    "month",
    "month_name",
    "week_of_year",
    "day_of_week",
    "is_weekend",
    "holiday_name",
    "season",
]
TABLE_NAMES = ["sales_transactions", "products", "stores", "calendar"]

_TYPES = {
    "transaction_date": DateType(),
    "quantity": IntegerType(),
    "unit_price": RAW_MONEY,
    "discount_percent": RAW_MONEY,
    "gross_revenue": RAW_MONEY,
    "net_revenue": RAW_MONEY,
    "unit_cost": RAW_MONEY,
    "total_cost": RAW_MONEY,
    "margin": RAW_MONEY,
    "base_price": RAW_MONEY,
    "base_cost": RAW_MONEY,
    "launch_date": DateType(),
    "is_active": BooleanType(),
    "opened_at": DateType(),
    "date": DateType(),
    "year": IntegerType(),
    "quarter": IntegerType(),
    "month": IntegerType(),
    "week_of_year": IntegerType(),
    "is_weekend": BooleanType(),
}


def _struct(columns: list[str], nullable: frozenset[str] = frozenset()) -> StructType:
    # The declared flags document intent only: the CSV reader makes every
    # field nullable, so the quality rules never rely on them.
    return StructType(
        [StructField(name, _TYPES.get(name, StringType()), name in nullable) for name in columns]
    )


SALES_SCHEMA = _struct(SALES_COLUMNS, frozenset({"product_id"}))
PRODUCT_SCHEMA = _struct(PRODUCT_COLUMNS)
STORE_SCHEMA = _struct(STORE_COLUMNS)
CALENDAR_SCHEMA = _struct(CALENDAR_COLUMNS, frozenset({"holiday_name"}))

SCHEMAS: dict[str, StructType] = {
    "sales_transactions": SALES_SCHEMA,
    "products": PRODUCT_SCHEMA,
    "stores": STORE_SCHEMA,
    "calendar": CALENDAR_SCHEMA,
}


class SchemaContractError(ValueError):
    """A file's header does not equal the expected column list."""


def check_header(found: list[str], expected: list[str], source: str = "") -> None:
    """Raise if a CSV header differs from the contract.

    Spark binds a user schema to CSV columns by position, so a reordered
    header would load wrong data silently; this check runs before the read.
    """
    if list(found) != list(expected):
        missing = [c for c in expected if c not in found]
        extra = [c for c in found if c not in expected]
        raise SchemaContractError(
            f"header mismatch{(' in ' + source) if source else ''}: "
            f"expected {expected}, found {list(found)} (missing={missing}, extra={extra})"
        )


def as_read(schema: StructType) -> StructType:
    """The schema as the CSV reader returns it: every field nullable."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
