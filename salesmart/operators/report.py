"""Quality report and row accounting.

Every count of the report comes from ONE aggregate pass over the checked
lines (conditional counts), plus one grouped count by reason combination;
only these single-row / small control results reach the driver.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.quality import QUALITY_REASON, reason_mentions

# Report time zone and run-id format.
REPORT_TIMEZONE = "Europe/Warsaw"
RUN_ID_FORMAT = "%Y%m%dT%H%M%S%z"

COUNT_COLUMNS = [
    "input_rows",
    "accepted_rows",
    "rejected_rows",
    "duplicate_rows",
    "missing_product_rows",
    "invalid_price_rows",
]


def report_counts(input_rows: DataFrame, checked: DataFrame) -> DataFrame:
    """One row with the six report counts.

    ``input_rows`` is a one-row, one-column frame holding the raw line count
    (before a duplicated dimension key could fan lines out), used as a
    scalar subquery; the other counts are conditional counts over the
    checked lines in a single pass.
    """
    rejected = F.col(QUALITY_REASON) != ""
    counts = checked.agg(
        input_rows.scalar().alias("input_rows"),
        F.count_if(~rejected).alias("accepted_rows"),
        F.count_if(rejected).alias("rejected_rows"),
        F.count_if(reason_mentions("duplicate_transaction")).alias("duplicate_rows"),
        F.count_if(
            reason_mentions("missing_product_id") | reason_mentions("unknown_product")
        ).alias("missing_product_rows"),
        F.count_if(reason_mentions("invalid_unit_price")).alias("invalid_price_rows"),
    )
    return counts.select(*COUNT_COLUMNS)


def counts_of_reasons(input_rows: int, accepted_rows: int, reasons: dict[str, int]) -> dict[str, int]:
    """The six report counts from the reason map: substring tests on whole combinations."""

    def mentioning(*labels: str) -> int:
        return sum(n for reason, n in reasons.items() if any(x in reason for x in labels))

    return {
        "input_rows": input_rows,
        "accepted_rows": accepted_rows,
        "rejected_rows": sum(reasons.values()),
        "duplicate_rows": mentioning("duplicate_transaction"),
        "missing_product_rows": mentioning("missing_product_id", "unknown_product"),
        "invalid_price_rows": mentioning("invalid_unit_price"),
    }


def count_rows(df: DataFrame, alias: str = "input_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def rejection_reasons(quarantine: DataFrame) -> DataFrame:
    """Rejected lines per whole reason combination (not per single rule)."""
    return quarantine.groupBy(QUALITY_REASON).agg(F.count(F.lit(1)).alias("row_count"))


def row_accounting(input_rows: DataFrame, checked: DataFrame) -> DataFrame:
    """input = accepted + rejected (fails only when a dimension key fans out)."""
    counts = checked.agg(
        input_rows.scalar().alias("input_rows"),
        F.count_if(F.col(QUALITY_REASON) == "").alias("accepted_rows"),
        F.count_if(F.col(QUALITY_REASON) != "").alias("rejected_rows"),
    )
    return counts.select(
        "input_rows",
        "accepted_rows",
        "rejected_rows",
        (F.col("input_rows") == F.col("accepted_rows") + F.col("rejected_rows")).alias("balanced"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table: the counts of a dataset manifest."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_stamp(now: _dt.datetime | None = None) -> dict[str, str]:
    """run_id, generated_at and timezone of a report (driver wall clock)."""
    tz = ZoneInfo(REPORT_TIMEZONE)
    moment = (now or _dt.datetime.now(tz)).astimezone(tz).replace(microsecond=0)
    return {
        "run_id": moment.strftime(RUN_ID_FORMAT),
        "generated_at": moment.isoformat(),
        "timezone": REPORT_TIMEZONE,
    }


def report_document(counts_row: dict, reasons: dict[str, int], now: _dt.datetime | None = None) -> dict:
    """The report as a dict: run fields, the six counts, the reason map."""
    doc: dict = dict(run_stamp(now))
    doc.update({k: int(counts_row[k]) for k in COUNT_COLUMNS})
    doc["rejection_reasons"] = dict(reasons)
    return doc
