"""Hand-made raw tables for unit tests (small in-memory frames)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators.calendar import build_calendar
from salesmart.schemas import PRODUCT_SCHEMA, SALES_SCHEMA, STORE_SCHEMA, as_read

D = Decimal


def _floats(rows):
    """Rows with DOUBLE money, as the raw contracts have it."""
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in rows]


def sale(tid="T1", oid="O1", day=dt.date(2025, 1, 1), product="P001", store="S001",
         channel="store", qty=1, price="48.20", disc="0.00", gross="48.20", net="48.20",
         ucost="31.75", tcost="31.75", margin="16.45", status="paid") -> tuple:
    def m(x):
        return None if x is None else D(x)

    return (tid, oid, day, product, store, channel, qty, m(price), m(disc), m(gross), m(net),
            m(ucost), m(tcost), m(margin), status)


def products(spark: SparkSession, rows=None) -> DataFrame:
    rows = rows or [
        ("P001", "Kettle", "kitchen", "Norra", D("41.50"), D("18.25"), dt.date(2023, 5, 2), True),
        ("P002", "Lamp", "lighting", "Velo", D("12.90"), D("6.10"), dt.date(2023, 9, 9), True),
    ]
    return spark.createDataFrame(_floats(rows), as_read(PRODUCT_SCHEMA))


def stores(spark: SparkSession, rows=None) -> DataFrame:
    rows = rows or [
        ("S001", "Porto", "Norte", "corner", dt.date(2021, 4, 7), "small_town"),
        ("S002", "Ghent", "Flanders", "arcade", dt.date(2022, 8, 30), "mid_city"),
    ]
    return spark.createDataFrame(rows, as_read(STORE_SCHEMA))


def tables(spark: SparkSession, sales_rows, product_rows=None, store_rows=None,
           start="2025-01-01", end="2025-01-31") -> dict[str, DataFrame]:
    return {
        "sales_transactions": spark.createDataFrame(_floats(sales_rows), as_read(SALES_SCHEMA)),
        "products": products(spark, product_rows),
        "stores": stores(spark, store_rows),
        "calendar": build_calendar(spark, start, end),
    }


def clean_lines(n: int = 30) -> list[tuple]:
    """n valid lines over 10 days, 2 products, 2 stores, some multi-line orders."""
    rows = []
    for i in range(n):
        order = i // 2
        product = "P001" if i % 2 == 0 else "P002"
        price = D("48.20") if product == "P001" else D("17.40")
        qty = 1 + i % 3
        gross = price * qty
        cost = (D("31.75") if product == "P001" else D("9.30")) * qty
        cancelled = order % 5 == 0
        net = D("0.00") if cancelled else gross
        margin = D("0.00") if cancelled else net - cost
        rows.append(sale(
            tid=f"T{i + 1:08d}", oid=f"O{order + 1:08d}", day=dt.date(2025, 1, 1 + order % 10),
            product=product, store="S001" if order % 2 == 0 else "S002",
            channel=["store", "online", "marketplace"][order % 3], qty=qty, price=str(price),
            gross=str(gross), net=str(net), ucost=str(cost / qty), tcost=str(cost),
            margin=str(margin), status="cancelled" if cancelled else "paid",
        ))
    return rows
