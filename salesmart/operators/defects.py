"""Known-bad line injection.

Three lines are picked by a total order (a top-3, not a full sort) and
appended with overrides: an exact copy of the first (a duplicate), the
second with negative price and revenue (invalid price), the third with an
unknown product. Only the three picked rows pass through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.money import money

# Ids, day offsets and amounts of the injected lines.
INVALID_PRICE_ID = ("T_INVALID_PRICE", "O_INVALID_PRICE")
MISSING_PRODUCT_ID = ("T_MISSING_PRODUCT", "O_MISSING_PRODUCT")
INVALID_PRICE_DAY_OFFSET = 10
MISSING_PRODUCT_DAY_OFFSET = 20
INVALID_PRICE_AMOUNT = "-99.00"
INVALID_PRICE_MARGIN = "-150.00"
UNKNOWN_PRODUCT = "UNKNOWN_PRODUCT"
PAID_STATUS = "paid"


class NotEnoughRows(ValueError):
    pass


def quality_issue_rows(
    sales: DataFrame, order_by: Sequence[str], start_date: DataFrame
) -> DataFrame:
    """The three injected lines.

    ``start_date`` is a one-row frame with a DATE column ``start``: the
    injected dates are start + 10 and start + 20 days.
    """
    picked = sales.orderBy(*order_by).limit(3)
    picked = picked.withColumn("_pick", F.row_number().over(Window.orderBy(*order_by)) - 1)
    picked = picked.withColumn("start", start_date.select("start").scalar())

    def money_like(value: str, column: str):
        return F.lit(value).cast(sales.schema[column].dataType) if column in sales.columns else money(F.lit(value))

    pick = F.col("_pick")
    overrides = {
        "transaction_id": F.when(pick == 1, F.lit(INVALID_PRICE_ID[0]))
        .when(pick == 2, F.lit(MISSING_PRODUCT_ID[0]))
        .otherwise(F.col("transaction_id")),
        "order_id": F.when(pick == 1, F.lit(INVALID_PRICE_ID[1]))
        .when(pick == 2, F.lit(MISSING_PRODUCT_ID[1]))
        .otherwise(F.col("order_id")),
        "transaction_date": F.when(pick == 1, F.date_add("start", INVALID_PRICE_DAY_OFFSET))
        .when(pick == 2, F.date_add("start", MISSING_PRODUCT_DAY_OFFSET))
        .otherwise(F.col("transaction_date")),
        "unit_price": F.when(pick == 1, money_like(INVALID_PRICE_AMOUNT, "unit_price")).otherwise(F.col("unit_price")),
        "gross_revenue": F.when(pick == 1, money_like(INVALID_PRICE_AMOUNT, "gross_revenue")).otherwise(
            F.col("gross_revenue")
        ),
        "net_revenue": F.when(pick == 1, money_like(INVALID_PRICE_AMOUNT, "net_revenue")).otherwise(
            F.col("net_revenue")
        ),
        "margin": F.when(pick == 1, money_like(INVALID_PRICE_MARGIN, "margin")).otherwise(F.col("margin")),
        "product_id": F.when(pick == 2, F.lit(UNKNOWN_PRODUCT)).otherwise(F.col("product_id")),
        "order_status": F.when(pick >= 1, F.lit(PAID_STATUS)).otherwise(F.col("order_status")),
    }
    return picked.select(
        *[overrides[c].alias(c) if c in overrides else F.col(c) for c in sales.columns]
    )


def inject_quality_issues(
    sales: DataFrame, order_by: Sequence[str], start_date: DataFrame
) -> DataFrame:
    """``sales`` UNION ALL the three injected lines (needs at least 3 lines)."""
    return sales.unionByName(quality_issue_rows(sales, order_by, start_date))


def require_rows(sales: DataFrame, n: int = 3) -> None:
    """Raise when ``sales`` has fewer than ``n`` lines (a bounded check)."""
    if sales.limit(n).count() < n:
        raise NotEnoughRows(f"at least {n} sales lines are needed to inject quality issues")
