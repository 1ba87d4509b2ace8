"""Command line: run one layer or all of them, e.g. under ``spark-submit``.

    python -m alloy all --landing s3a://landing/marketplace --bronze s3a://bronze \\
        --silver s3a://silver --gold s3a://gold [--quarantine s3a://quarantine] \\
        [--kpis] [--checks] [--resume] [--limit negative_value:dim_pagamentos:100] \\
        [--single-line TABLE] [--buckets 512] [--s3-endpoint http://store:9000]

Prints the run report as JSON; the exit status is 1 when any table failed or
gold was held back.
"""

from __future__ import annotations

import argparse
import json
import sys

from alloy.plans.medallion import (Layout, LayerError, Limit, NoLandingFiles, RunReport, run_bronze,
                                   run_gold, run_layers, run_silver)
from alloy.plans.marketplace import GOLD_TABLES, KPI_TABLES
from alloy.session import get_spark, object_store_conf


def limit(text: str) -> Limit:
    check, table, most = text.split(":")
    return Limit(check, table, int(most))


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="alloy", description=__doc__.splitlines()[0])
    p.add_argument("stage", choices=["bronze", "silver", "gold", "all"])
    for layer in ("landing", "bronze", "silver", "gold"):
        p.add_argument(f"--{layer}", required=True)
    p.add_argument("--quarantine")
    p.add_argument("--kpis", action="store_true", help="also write the indicator tables")
    p.add_argument("--checks", action="store_true", help="print the gold quality report")
    p.add_argument("--resume", action="store_true", help="keep tables whose inputs, specs and code haven't changed")
    p.add_argument("--limit", type=limit, action="append", default=[], metavar="CHECK:TABLE:MOST",
                   help="publish gold only if the check finds at most so many bad rows")
    p.add_argument("--single-line", action="append", default=[], metavar="TABLE",
                   help="a landing table without line breaks in its values")
    p.add_argument("--buckets", type=int, help="lay out the tables of the fact's join in so many buckets")
    p.add_argument("--parallel", type=int, default=4)
    p.add_argument("--s3-endpoint")
    p.add_argument("--master")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    conf = object_store_conf(args.s3_endpoint) if args.s3_endpoint else {}
    spark = get_spark("alloy", args.master, conf)
    layout = Layout(args.landing, args.bronze, args.silver, args.gold, args.quarantine)
    gold_tables = {**GOLD_TABLES, **KPI_TABLES} if args.kpis else GOLD_TABLES
    if args.stage == "all":
        try:
            report = run_layers(spark, layout, raise_on_failure=False, parallel=args.parallel, kpis=args.kpis,
                                single_line=args.single_line, limits=args.limit, resume=args.resume,
                                buckets=args.buckets)
        except NoLandingFiles as e:
            print(str(e), file=sys.stderr)
            return 2
    else:
        report = RunReport()
        common = {"parallel": args.parallel, "resume": args.resume}
        run = {"bronze": lambda: run_bronze(spark, layout, report, single_line=args.single_line, **common),
               "silver": lambda: run_silver(spark, layout, report, buckets=args.buckets, **common),
               "gold": lambda: run_gold(spark, layout, report, tables=gold_tables, limits=args.limit, **common)}
        run[args.stage]()
    out = {"report": report.as_dict(), "seconds": report.seconds, "misfits": report.misfits, "repeated_files": report.repeated,
           "limits_checked": report.checks, "limits_exceeded": report.exceeded}
    if args.checks and args.stage in ("gold", "all") and not report.failed():
        from alloy.plans.lake_checks import quality_report
        out["checks"] = [r.asDict() for r in quality_report(spark, layout.gold).collect()]
    print(json.dumps(out, indent=2))
    if report.failed():
        print(LayerError(report.as_dict(), report.exceeded), file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
