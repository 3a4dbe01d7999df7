"""Command line: build warehouse tables from a landing folder.

    python -m daybook --landing DIR --out DIR [--start 2024-01-01] [--end 2024-12-31]
                      [--tables equity|date|all|name,name] [--partition-by-year]
                      [--history-format parquet|csv] [--versioned] [--preview N]

Prints one line per table with the counts gathered while it was written.
"""

from __future__ import annotations

import argparse
import json
import os
from datetime import date

from daybook.plans.build import DATE_TABLES, EQUITY_TABLES, TABLES, build_all
from daybook.plans.sinks import preview
from daybook.plans.versions import read_table
from daybook.session import cluster_conf, get_session

PRESETS = {"all": TABLES, "equity": EQUITY_TABLES, "date": DATE_TABLES}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="daybook", description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True, help="folder with the landed input files")
    ap.add_argument("--out", required=True, help="warehouse folder; each table goes to <out>/<table>")
    ap.add_argument("--start", default="2024-01-01", type=date.fromisoformat,
                    help="first day (calendar and filings inclusive, histories inclusive)")
    ap.add_argument("--end", default="2024-12-31", type=date.fromisoformat,
                    help="last day (calendar and filings inclusive, histories exclusive)")
    ap.add_argument("--tables", default="all",
                    help="all, equity, date, or a comma-separated list of table names")
    ap.add_argument("--partition-by-year", action="store_true",
                    help="write the daily, FX and extended tables partitioned by year")
    ap.add_argument("--history-format", choices=["parquet", "csv"], default="parquet",
                    help="price/FX history as Parquet, or one CSV per ticker/symbol")
    ap.add_argument("--facts-json-lines", action="store_true",
                    help="company facts as JSON Lines instead of one document per file")
    ap.add_argument("--versioned", action="store_true",
                    help="publish each table as a version (atomic replace) instead of plain files at its path")
    ap.add_argument("--preview", type=int, default=0, help="show the first N rows of each table")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    ap.add_argument("--input-gb", type=float, default=0, help="size of the landed input, to size the shuffles by")
    args = ap.parse_args(argv)

    tables = PRESETS.get(args.tables) or [t.strip() for t in args.tables.split(",") if t.strip()]
    spark = get_session(args.master, app_name="daybook-build")
    try:
        if args.input_gb:
            sizing = cluster_conf(int(args.input_gb * (1 << 30)), spark.sparkContext.defaultParallelism)
            for key, value in sizing.items():
                spark.conf.set(key, value)
        report = build_all(spark, args.landing, args.out, args.start, args.end,
                           partition_by_year=args.partition_by_year, tables=tables,
                           history_format=args.history_format,
                           facts_json_lines=args.facts_json_lines, versioned=args.versioned)
        for name, counts in report.items():
            print(json.dumps({"table": name, **counts}))
            if args.preview:
                preview(read_table(spark, os.path.join(args.out, name)), args.preview)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
