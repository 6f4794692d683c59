"""Command line: ``python -m firmo build <sf_dir> [--master local[8]]``.

Builds one run (staging, raw and mart tables in the shared checkpoint folder),
then prints row counts and the quality report; check failures are reported,
not raised, as in the reference's schedule."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from firmo.session import get_spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="firmo")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build the layers of one run and report checks")
    b.add_argument("sf_dir")
    b.add_argument("--master", default=None)
    b.add_argument("--shuffle-partitions", type=int, default=None)
    args = ap.parse_args(argv)

    spark = get_spark(args.master, args.shuffle_partitions)
    from firmo import catalog
    from firmo.plans.runs import staged
    from firmo.operators.setops import union_row_counts
    run = staged(spark, args.sf_dir)
    counts = union_row_counts({"stg_primary": run.stg_primary, "stg_secondary": run.stg_secondary,
                               "raw_dim_companies": run.raw_dim, "raw_fct_company_metrics": run.raw_fct,
                               "unified_companies": run.mart})
    report = catalog.QUERIES["quality_report"](spark, args.sf_dir)
    print(json.dumps({"root": run.root,
                      "tables": {r.table_name: r.row_count for r in counts.collect()},
                      "failed_checks": [r.check_name for r in report.filter(~F.col("passed")).collect()]}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
