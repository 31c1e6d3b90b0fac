"""Command line: `python -m snapmart [run|profile|export]`, or `run_datamart.py` under spark-submit.

run builds the tables and reports, profile saves the profiles of tables that are there, export writes the reviewed
financials as CSV.
"""

from __future__ import annotations

import argparse
from datetime import date

from snapmart.plans.datamart import LAYERS, DatamartConfig, run_datamart, run_export, run_profiles
from snapmart.plans.profiling import PROFILES
from snapmart.schemas import DATASETS
from snapmart.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="snapmart", description="Build the credit-risk datamart.")
    parser.add_argument("command", nargs="?", choices=("run", "profile", "export"), default="run")
    parser.add_argument("--root", required=True, help="folder of the bronze, silver and gold tables")
    parser.add_argument("--source", action="append", default=[], metavar="DATASET=PATH",
                        help=f"raw file, folder or glob of one of {', '.join(DATASETS)}")
    parser.add_argument("--start", type=date.fromisoformat, default=DatamartConfig.start)
    parser.add_argument("--end", type=date.fromisoformat, default=DatamartConfig.end)
    parser.add_argument("--snapshot", type=date.fromisoformat, action="append",
                        help="build only this month; may be repeated")
    parser.add_argument("--layer", action="append", choices=LAYERS, help="build only this layer; may be repeated")
    parser.add_argument("--dpd", type=int, default=DatamartConfig.dpd)
    parser.add_argument("--mob", type=int, default=DatamartConfig.mob)
    parser.add_argument("--strict", action="store_true", help="fail on the first malformed value")
    parser.add_argument("--bronze-csv", action="store_true", help="write the bronze tables as CSV too")
    parser.add_argument("--customer-buckets", type=int, default=0, metavar="N",
                        help="bucket the silver tables of customers, so that their join needs no exchange")
    parser.add_argument("--profile", action="append", choices=PROFILES, help="save only this profile; may be repeated")
    parser.add_argument("--out", help="folder of the export")
    parser.add_argument("--master")
    options = parser.parse_args(arguments)

    sources = dict(item.split("=", 1) for item in options.source)
    unknown = set(sources) - set(DATASETS)
    if unknown:
        parser.error(f"unknown datasets: {sorted(unknown)}")
    if options.command == "export" and not options.out:
        parser.error("export needs --out")
    config = DatamartConfig(
        options.root, sources, options.start, options.end, options.dpd, options.mob, options.strict, options.bronze_csv,
        options.customer_buckets,
    )
    spark = build_session(master=options.master)
    try:
        if options.command == "profile":
            print("\n".join(run_profiles(spark, config, options.profile or list(PROFILES))))
        elif options.command == "export":
            run_export(spark, config, options.out)
        else:
            rows = run_datamart(spark, config, options.snapshot, options.layer or LAYERS)
            for table, per_snapshot in rows.items():
                print(table, {day.isoformat(): n for day, n in per_snapshot.items()})
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
