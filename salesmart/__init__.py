"""salesmart: a Spark-native quality and rollup engine for retail order lines.

Raw order lines and their product, store and calendar dimensions are
normalised, de-duplicated, enriched through star joins, checked against
named quality rules and split into accepted facts (silver) and a
quarantine that keeps every rejected line with its reasons. Daily gold
rollups, a quality report and dataset checks are built from those.

Every operator is a DataFrame / Spark SQL transformation; nothing is
collected to the driver except single-row control results (counts).
"""

from salesmart.schemas import (  # noqa: F401
    CALENDAR_SCHEMA,
    PRODUCT_SCHEMA,
    SALES_SCHEMA,
    STORE_SCHEMA,
)

__all__ = ["CALENDAR_SCHEMA", "PRODUCT_SCHEMA", "SALES_SCHEMA", "STORE_SCHEMA"]
