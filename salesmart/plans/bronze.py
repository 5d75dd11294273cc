"""Bronze ingest (A4): each raw table as Parquet with its ingest time.

The sales table also gets its ingest order ``_source_row_id`` here, once:
later stages read the persisted id, so the first copy of a duplicated
transaction no longer depends on how a re-execution splits the input.
The CSV text is parsed exactly once; silver and the report read bronze.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.normalize import SOURCE_ROW_ID, add_source_row_id
from salesmart.plans.actions import concurrently
from salesmart.sources.files import read_parquet, write_parquet

INGESTED_AT = "ingested_at"


def with_ingest_columns(name: str, df: DataFrame) -> DataFrame:
    if name == "sales_transactions" and SOURCE_ROW_ID not in df.columns:
        df = add_source_row_id(df)
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def write_bronze(tables: dict[str, DataFrame], bronze_root: str) -> dict[str, str]:
    """Write every table under ``bronze_root/<name>``; returns the paths."""
    paths = {name: f"{bronze_root.rstrip('/')}/{name}" for name in tables}
    concurrently(
        *[
            (lambda n=name, df=df: write_parquet(with_ingest_columns(n, df), paths[n]))
            for name, df in tables.items()
        ]
    )
    return paths


def read_bronze(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: read_parquet(spark, path) for name, path in paths.items()}


def bronze_tables(
    spark: SparkSession, tables: dict[str, DataFrame], bronze_root: str
) -> dict[str, DataFrame]:
    """Write bronze and return the written tables as read back."""
    return read_bronze(spark, write_bronze(tables, bronze_root))


def without_ingest_time(df: DataFrame) -> DataFrame:
    return df.drop(INGESTED_AT) if INGESTED_AT in df.columns else df
