"""Warehouse path layout (A11): raw inputs and the medallion layers as URIs.

Plain strings so any Hadoop file system works (``s3a://``, ``abfss://``,
``hdfs://``, ``file:/``); nothing is resolved on the driver's disk.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

# Raw file names and layer directory names.
RAW_FILES = {
    "sales_transactions": "sales_transactions.csv",
    "products": "products.csv",
    "stores": "stores.csv",
    "calendar": "calendar.csv",
}
MANIFEST_FILE = "generation_manifest.json"
REPORT_FILE = "quality_report.json"


def _join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


@dataclass(frozen=True)
class Layout:
    raw_uri: str
    warehouse_uri: str

    def raw_path(self, table: str) -> str:
        return _join(self.raw_uri, RAW_FILES[table])

    @property
    def sales_path(self) -> str:
        return self.raw_path("sales_transactions")

    @property
    def products_path(self) -> str:
        return self.raw_path("products")

    @property
    def stores_path(self) -> str:
        return self.raw_path("stores")

    @property
    def calendar_path(self) -> str:
        return self.raw_path("calendar")

    @property
    def manifest_path(self) -> str:
        return _join(self.raw_uri, MANIFEST_FILE)

    @property
    def bronze_dir(self) -> str:
        return _join(self.warehouse_uri, "bronze")

    @property
    def silver_dir(self) -> str:
        return _join(self.warehouse_uri, "silver")

    @property
    def silver_sales_path(self) -> str:
        return _join(self.silver_dir, "sales_enriched")

    @property
    def quarantine_dir(self) -> str:
        return _join(self.warehouse_uri, "quarantine")

    @property
    def quarantine_sales_path(self) -> str:
        return _join(self.quarantine_dir, "sales_transactions")

    @property
    def gold_dir(self) -> str:
        return _join(self.warehouse_uri, "gold")

    @property
    def partials_dir(self) -> str:
        """Mergeable partials that the gold tables are finished from."""
        return _join(self.warehouse_uri, "gold_partials")

    def incoming(self, run: str) -> Layout:
        """Where a run writes before its outputs are published."""
        return Layout(self.raw_uri, _join(self.warehouse_uri, f"incoming-{run}"))

    #: Directories that a run replaces.
    published: ClassVar[tuple[str, ...]] = (
        "bronze_dir", "silver_dir", "quarantine_dir", "partials_dir", "gold_dir",
    )

    def gold_path(self, table: str) -> str:
        return _join(self.gold_dir, table)

    @property
    def quality_report_path(self) -> str:
        return _join(self.warehouse_uri, REPORT_FILE)
