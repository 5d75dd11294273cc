"""Command line (J6, J7): ``spark-submit -m salesmart.cli <command> ...``.

* ``pipeline [--raw-dir URI] [--warehouse-dir URI]``: run every layer, print the report.
* ``fixtures --sf-dir DIR [--raw-dir URI]``: write the raw CSVs from driver tables.
* ``all --sf-dir DIR [--raw-dir URI] [--warehouse-dir URI]``: both.

The session comes from ``spark-submit`` (master, memory and the shared
checkpoint directory are cluster settings); ``--local N`` builds a local one.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from salesmart.plans.job import run
from salesmart.session import local_session
from salesmart.sources.fixtures import build_raw_dataset
from salesmart.sources.layout import Layout

#: Used where the caller names none; relative to Spark's default file system.
RAW_DIR = "data/raw"
WAREHOUSE_DIR = "data/warehouse"


def _session(args: argparse.Namespace) -> SparkSession:
    if args.local:
        return local_session(args.local)
    return SparkSession.builder.appName("salesmart").getOrCreate()


def _directories(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--raw-dir", default=RAW_DIR)
    parser.add_argument("--warehouse-dir", default=WAREHOUSE_DIR)
    parser.add_argument(
        "--split-heavy-keys",
        action="store_true",
        help="for products or stores beyond the broadcast size: deal lines of heavy keys over many tasks",
    )


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(description="Retail sales quality and rollup jobs on Spark.")
    parser.add_argument("--local", type=int, default=0, help="run on local[N] instead of the submitted master")
    sub = parser.add_subparsers(dest="command", required=True)
    pipe = sub.add_parser("pipeline", help="bronze, silver, quarantine, gold and the report")
    _directories(pipe)
    fix = sub.add_parser("fixtures", help="raw CSVs from the driver tables")
    fix.add_argument("--sf-dir", required=True)
    fix.add_argument("--raw-dir", default=RAW_DIR)
    fix.add_argument("--no-defects", action="store_true")
    fix.add_argument("--sales-files", type=int, default=None)
    both = sub.add_parser("all", help="fixtures, then pipeline")
    both.add_argument("--sf-dir", required=True)
    _directories(both)
    both.add_argument("--no-defects", action="store_true")
    both.add_argument("--sales-files", type=int, default=None)
    args = parser.parse_args(argv)

    spark = _session(args)
    layout = Layout(args.raw_dir, getattr(args, "warehouse_dir", args.raw_dir))
    if args.command in ("fixtures", "all"):
        result = build_raw_dataset(
            spark, args.sf_dir, layout, inject_defects=not args.no_defects, sales_files=args.sales_files
        )
    if args.command in ("pipeline", "all"):
        result = run(spark, layout, split_heavy=args.split_heavy_keys)
    print(json.dumps(result, indent=2))
    return result


if __name__ == "__main__":
    main()
