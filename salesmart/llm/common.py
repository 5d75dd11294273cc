"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word separators; a word is a run of anything else.
SEPARATOR_CHARS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ship_package(spark: SparkSession) -> None:
    """Sends this package's modules to the Python workers, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_salesmart_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="salesmart-"), "salesmart_modules.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("salesmart", os.path.relpath(full, package)))
    sc.addPyFile(path)
    sc._salesmart_shipped = True


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def plainly_named(df: DataFrame) -> DataFrame:
    """The columns as c0, c1, ...: names with dots, spaces or clashes need no care."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def map_same_columns(df: DataFrame, fn: Callable) -> DataFrame:
    """``fn`` over Arrow batches, whose columns it gets and returns by place; ``df``'s names and types stay."""
    from pyspark.sql.types import StructField, StructType

    plain = plainly_named(df)
    schema = StructType([StructField(f.name, f.dataType, True) for f in plain.schema])
    return map_batches(plain, fn, schema).toDF(*df.columns)


def map_rows(
    df: DataFrame, row_fn: Callable[..., tuple], schema: str, per_batch: int = 500
) -> DataFrame:
    """``row_fn(*columns) -> tuple`` over every row in Arrow batches.

    ``row_fn`` may be a factory marked with ``is_factory = True``: it is then
    called once for each task and returns the row function.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = row_fn() if getattr(row_fn, "is_factory", False) else row_fn
        for batch in batches:
            for at in range(0, batch.num_rows, per_batch):
                part = batch.slice(at, per_batch)
                columns = [c.to_pylist() for c in part.columns]
                rows = [fn(*values) for values in zip(*columns)]
                arrays = [
                    pa.array(values, type=field.type)
                    for values, field in zip(zip(*rows), out_schema)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)

    return map_batches(df, run, schema)


def span_text(spans: list[tuple]) -> str:
    """``kind:start:end`` of each span, comma-joined, in the given order."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
