"""File sources and sinks: CSV in, Parquet and JSON out.

Paths are URIs (any Hadoop file system); nothing here touches the local
disk of the driver except through Spark.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.schemas import check_header

# Writing: keep padding and distinguish NULL from empty text, so a round
# trip returns the same values (Spark trims on write by default).
_CSV_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file's header line (reads one line per file)."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path).columns


#: Where a line was read: its file, and the start of its split in the file.
ORIGIN_COLUMNS = ["_source_file", "_source_block"]


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    check_columns: bool = True,
    origin: bool = False,
) -> DataFrame:
    """CSV with header and an explicit schema (no inference).

    Unparsable values become NULL (PERMISSIVE mode) and surface later as a
    quality-rule hit. Spark binds a given schema by position, so headers are
    checked: ``enforceSchema=false`` makes the scan validate the header of
    EVERY file against the schema's names (a mismatch fails the read and
    names the file); with ``check_columns`` the first file is also checked
    up front on the driver, for an early, typed error. ``origin`` adds
    ORIGIN_COLUMNS, from which the order of lines over many files follows.
    """
    if check_columns:
        check_header(read_header(spark, path), schema.fieldNames(), path)
    lines = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    if not origin:
        return lines
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_source_block"),
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """CSV dataset with header (one file per partition); readers tell a compressed file by its name."""
    writer = df.write.mode(mode).option("compression", compression)
    for key, value in _CSV_WRITE_OPTIONS.items():
        writer = writer.option(key, value)
    writer.csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    dealt: bool = False,
) -> None:
    """A Parquet dataset (zstd); partitioned rows are dealt out by partition first.

    Dealing out (``rebalance``) puts a partition's rows into few tasks, so it
    gets few files, and adaptive execution splits a large partition over tasks
    of about the advisory size, so its files are bounded and no task gets all.
    ``dealt``: the rows are dealt out so already, or are to be written where they
    lie, a file for each task and partition (see ``read_by_directory``).
    """
    if not partition_by:
        df.write.mode(mode).parquet(path, compression="zstd")
        return
    rows = df if dealt else df.hint("rebalance", *[F.col(c) for c in partition_by])
    rows.write.mode(mode).partitionBy(*partition_by).parquet(path, compression="zstd")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _renamed(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _file_system(spark, source)
    if not fs.rename(old, _file_system(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def write_json_file(spark: SparkSession, document: dict, path: str) -> None:
    """One JSON document as one file, through the Hadoop file system of its URI.

    Written under another name and then renamed, so a reader finds the whole
    old document or the whole new one, and a failed write leaves the old one.
    """
    whole = bytearray(json.dumps(document, indent=2).encode("utf-8"))
    aside = f"{path}.{uuid.uuid4().hex[:12]}.tmp"
    fs, draft = _file_system(spark, aside)
    try:
        out = fs.create(draft, True)
        try:
            out.write(whole)
        finally:
            out.close()
        hadoop = spark._jvm.org.apache.hadoop.fs
        options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        options[0] = hadoop.Options.Rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(draft), fs.makeQualified(hadoop.Path(path)), options)
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def publish(spark: SparkSession, moves: dict[str, str]) -> None:
    """Put written directories in the place of published ones (``{incoming: published}``).

    Call it when all of them are complete. Each published directory is renamed
    aside, the new one renamed into its place, and the old ones deleted once all
    are in place; if a rename fails, the old directories are put back. A rename
    moves no data on a file system that has it.
    """
    mark = uuid.uuid4().hex[:12]
    done: list[tuple[str, str, str | None]] = []
    try:
        for source, target in moves.items():
            fs, place = _file_system(spark, target)
            aside = f"{target}.{mark}.old" if fs.exists(place) else None
            if aside:
                _renamed(spark, target, aside)
            done.append((source, target, aside))
            fs.mkdirs(place.getParent())
            _renamed(spark, source, target)
    except Exception:
        for source, target, aside in reversed(done):
            fs, place = _file_system(spark, target)
            if fs.exists(place):
                _renamed(spark, target, source)
            if aside:
                _renamed(spark, aside, target)
        raise
    for _, _, aside in done:
        if aside:
            fs, old = _file_system(spark, aside)
            fs.delete(old, True)


#: Spark's setting that deletes a query's shuffle files when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_freed(spark: SparkSession) -> Iterator[None]:
    """Within it a write's shuffle files go as soon as it ends; else they stay until the driver collects garbage.

    For steps whose frames are evaluated once each: a frame evaluated again
    would shuffle again. The session's own setting is put back at the end.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


#: A stored directory of so many bytes is read in place when its rows are gathered.
LARGE_DIRECTORY = 1 << 20
#: Bytes of a large directory that one task reads, about.
BYTES_PER_TASK = 32 << 20


def directory_sizes(spark: SparkSession, path: str, levels: int) -> dict[str, int]:
    """Bytes in each directory ``levels`` below ``path``, of a dataset stored by as many columns."""
    found = [path]
    for _ in range(levels):
        inside = []
        for parent in found:
            fs, place = _file_system(spark, parent)
            inside += [s.getPath().toString() for s in fs.listStatus(place) if s.isDirectory()]
        found = inside
    sizes = {}
    for directory in found:
        fs, place = _file_system(spark, directory)
        sizes[directory] = fs.getContentSummary(place).getLength()
    return sizes


def read_by_directory(spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a dataset stored by ``partition_by`` (its tasks wrote a file each there), dealt out by these columns.

    A large directory is read in place, by tasks of its own: no row is moved, as
    stored rows take far fewer bytes than shuffled ones. The rows of the small
    ones, of which a task can read many, are dealt out by ``rebalance``.
    """
    sizes = directory_sizes(spark, path, len(partition_by))
    large = {d: n for d, n in sizes.items() if n >= LARGE_DIRECTORY}
    small = [d for d in sizes if d not in large] or ([] if large else [path])

    def rows(*directories: str) -> DataFrame:
        return spark.read.schema(schema).option("basePath", path).parquet(*directories)

    # at least two tasks each: Spark would unite frames of one partition into one partition
    parts = [rows(d).coalesce(max(2, -(-n // BYTES_PER_TASK))) for d, n in large.items()]
    if small:
        parts.append(rows(*small).hint("rebalance", *[F.col(c) for c in partition_by]))
    return reduce(DataFrame.union, parts)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory that this run made."""
    fs, place = _file_system(spark, path)
    if fs.exists(place):
        fs.delete(place, True)


def read_json_file(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def release(spark: SparkSession, path: str) -> None:
    """Free a scratch table's storage once nothing reads it any more.

    Overwriting the location with an empty dataset removes the old files
    through Spark's own file-system layer (any Hadoop URI).
    """
    spark.range(0).write.mode("overwrite").parquet(path)
