"""Command line: ``python -m finlake import|metadata|transform``.

  import     --warehouse W --source-path P [--source-path P2 ...] [--project-path R] [--input-format csv|parquet]
  metadata   --warehouse W --metadata-path M
  transform  --warehouse W --output-path O --range-start YYYY/MM/DD --range-end YYYY/MM/DD
"""

from __future__ import annotations

import argparse
import logging
import sys
import time

from finlake.plans.jobs import import_job, metadata_job, transform_job
from finlake.plans.warehouse import Warehouse
from finlake.session import get_session


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--warehouse", required=True, help="root folder of the warehouse tables")
    common.add_argument("--master", default=None, help="Spark master (default: from the environment)")

    p = argparse.ArgumentParser(prog="finlake")
    sub = p.add_subparsers(dest="command", required=True)
    imp = sub.add_parser("import", parents=[common], help="import new extracts from source folders")
    imp.add_argument("--source-path", action="append", required=True)
    imp.add_argument("--project-path", default=None, help="prefix for relative source paths")
    imp.add_argument("--input-format", default="csv", choices=["csv", "parquet"])
    imp.add_argument(
        "--multi-line",
        choices=["auto", "yes", "no"],
        default="auto",
        help="read whole files in one task: where quoted fields hold line breaks (auto), always, or never",
    )
    meta = sub.add_parser("metadata", parents=[common], help="replace the dimension tables")
    meta.add_argument("--metadata-path", required=True)
    tr = sub.add_parser("transform", parents=[common], help="build the gold dataset")
    tr.add_argument("--output-path", required=True)
    tr.add_argument("--range-start", required=True, help="first day included, YYYY/MM/DD")
    tr.add_argument("--range-end", required=True, help="first day excluded, YYYY/MM/DD")
    tr.add_argument(
        "--replace-scope",
        default="scenario",
        choices=["scenario", "month"],
        help="replace the months of the scenarios produced, or of all scenarios",
    )
    return p


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    args = parser().parse_args(argv)
    spark = get_session(args.master)
    try:
        run(spark, args)
    finally:
        spark.stop()
    return 0


def run(spark, args: argparse.Namespace) -> None:
    wh = Warehouse(args.warehouse)
    if args.command == "import":
        roots = [f"{args.project_path.rstrip('/')}/{p}" if args.project_path else p for p in args.source_path]
        report = import_job(spark, wh, roots, args.input_format, {"auto": None, "yes": True, "no": False}[args.multi_line])
        print(f"ingested {report.ingested_count} files, rejected {len(report.rejected)}, "
              f"duplicate names skipped {len(report.duplicates)}")
        for r in report.rejected:
            print(f"  rejected {r.path}: {r.reason}")
    elif args.command == "metadata":
        for table, n in metadata_job(spark, wh, args.metadata_path).items():
            print(f"updated dimension table {table} with {n} records")
    else:
        tic = time.perf_counter()
        gold = transform_job(spark, wh, args.output_path, args.range_start, args.range_end, replace_scope=args.replace_scope)
        print(f"gold dataset: {gold.count()} rows in {time.perf_counter() - tic:0.2f} seconds")


if __name__ == "__main__":
    sys.exit(main())
