"""Write PLANS.md: the physical plan shapes of the main paths.

Usage: python scripts/explain_plans.py [sf_dir]

For each path: the operator tree of ``explain("formatted")`` and the scan
lines (PushedFilters / ReadSchema), taken from the final adaptive plan
after one execution.
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from salesmart.plans.catalog import catalog  # noqa: E402
from salesmart.plans import lattice  # noqa: E402
from salesmart.session import local_session, scratch_uri  # noqa: E402

PATHS = {
    "metric_overview_daily": "silver-only path: WindowGroupLimit, inner joins, partial+final aggregates",
    "duplicate_rank": "rank: numbered keys with prefix offsets, later copies joined back to the lines",
    "rejection_reasons": "checked path: ranks joined back, outer joins, reason string, grouped count",
    "quality_report": "report: one conditional-count pass + scalar subquery",
    "silver_month_pruned": "one month of the stored silver lines: directories pruned",
    "check_dataset_equal": "fingerprints by hash bucket, then only rows of differing buckets",
}


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0].split("+- == Initial Plan ==")[0].rstrip()
    scans = [
        line.strip()
        for line in text.splitlines()
        if line.startswith(("PushedFilters", "ReadSchema", "PartitionFilters")) and "[]" not in line
    ]
    return tree + "\n\n" + "\n".join(dict.fromkeys(scans))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    cat = catalog()
    out = ["# PLANS", "", f"Final adaptive plans at `{sf_dir}` on local[8] (generated by `scripts/explain_plans.py`).", ""]
    for name, what in PATHS.items():
        df = cat[name](spark, sf_dir)
        df.collect()  # small results; executing this DataFrame makes its plan final
        out += [f"## {name}", "", what, "", "```", formatted(df), "```", ""]
    silver = cat["silver_sales"](spark, sf_dir)
    root = scratch_uri(spark, "plans")
    lattice.write_partials(silver, root, "run")
    for name, df in lattice.gold_from(*lattice.read_partials(spark, root)).items():
        df.collect()
        out += [f"## gold from stored partials: {name}", "", "```", formatted(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
