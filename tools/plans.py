"""Summarize the executed (AQE final) physical plan of every registered query.

Usage: python tools/plans.py [sf_dir] > PLANS.md
Per query: shuffles by kind, broadcasts, join and aggregate operators,
windows, and per scan the pushed filters and the columns read.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.plans.queries import QUERIES  # noqa: E402
from daybook.session import get_session  # noqa: E402

COUNTED = [
    ("hash shuffles", r"Exchange hashpartitioning"),
    ("range shuffles", r"Exchange rangepartitioning"),
    ("single-partition shuffles", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("sort-merge joins", r"SortMergeJoin"),
    ("broadcast hash joins", r"BroadcastHashJoin"),
    ("shuffled hash joins", r"ShuffledHashJoin"),
    ("hash aggregates", r"HashAggregate"),
    ("sort aggregates", r"SortAggregate"),
    ("windows", r"(?<!Group)Window(?!GroupLimit)\b"),
    ("window group limits", r"WindowGroupLimit"),
    ("python evaluation", r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)"),
]


# What grows with the data in each query, and what bounds the rest.
NOTES = {
    "asof_market_cap": "Daily rows and filings are grouped together by (ticker, day), partially before the shuffle; "
                       "one window per ticker, bounded by its days, carries the filing. Filings: one scan of the facts.",
    "asof_market_cap_monthly": "Daily rows and filings go once by (ticker, month) and are read there by both levels of the fill; "
                               "what carries across months is one row per (ticker, month).",
    "asof_market_cap_bucketed": "Scans of published tables in buckets by ticker: no shuffle above them.",
    "asof_hot_ticker": "The key spine; a ticker above the row bound is cut at percentiles of its own times, "
                       "found by a count and a percentile aggregate; at most rows / bound edges are broadcast.",
    "built_extended": "The scan of a published table; the build's own jobs run before it.",
    "shares_outstanding": "Facts read once; one partial aggregate per (CIK, concept, period); the concept "
                          "choice is a window per CIK over aggregated groups.",
    "shares_outstanding_json": "As shares_outstanding; documents are made from numbered facts (a global sort) and parsed "
                               "with a schema pruned to the listed concepts; they hold at most 1000 entries.",
    "daily_prices": "History filtered at the scan; Spark broadcasts the ticker list by its measured bytes.",
    "daily_prices_repeated": "As daily_prices.",
    "daily_prices_csv": "As daily_prices, from lines bound by their file's header; headers broadcast within a measured bound.",
    "daily_fx": "As daily_prices, with the pair list.",
    "daily_fx_csv": "As daily_fx, from lines.",
    "fx_rejects": "The same lines, the other ones.",
    "currency_pairs": "A distinct over events (partial aggregate); the list's lines parsed in the plan.",
    "cik_map": "One partial aggregate per ticker (max_by position).",
    "cik_map_json": "JSON objects of at most 1000 entries, made and parsed in the plan.",
    "asset_dimension": "Counts per ticker (partial), ranks within ranges, offsets over one row per range, expanded to rows.",
    "trading_calendar": "A global min/max (partial aggregates), then a per-row expression over the days.",
    "trading_calendar_event_years": "As trading_calendar.",
    "open_days": "As trading_calendar plus a filter.",
    "latest_per_key": "As the flagship, over quotes with many rows a day.",
    "latest_per_customer": "As latest_per_key, over orders.",
    "missing_filings": "The flagship plus a filter.",
    "coverage_report": "The flagship and the calendar, each reduced by one global aggregate.",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8, extra_conf={
        "spark.sql.maxMetadataStringLength": "100000"})
    print(f"# Executed plans of the registered queries ({os.path.basename(sf_dir)}, AQE final plans)\n")
    print("Generated by `python tools/plans.py`. Counts are operators in the final physical plan "
          "(a reused exchange is counted once per use).\n")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # keep the final plan only
        print(f"## {name}\n")
        if name in NOTES:
            print(f"_Scale:_ {NOTES[name]}\n")
        counts = [(label, len(re.findall(pat, plan))) for label, pat in COUNTED]
        print(", ".join(f"{label}: {n}" for label, n in counts if n) or "no shuffles")
        print()
        scans = set()
        for line in plan.splitlines():
            if "FileScan" not in line:
                continue
            table = re.search(r"/(\w+)(\.parquet)?\]", line)
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)
            cols = re.search(r"FileScan \w+ \[([^\]]*)\]", line)
            ncols = len(cols.group(1).split(",")) if cols and cols.group(1) else 0
            scans.add(f"- scan `{table.group(1) if table else '?'}`: {ncols} column(s) read; "
                      f"pushed filters: {(pushed.group(1) if pushed else '') or 'none'}")
        for entry in sorted(scans):
            print(entry)
        print()
    spark.stop()


if __name__ == "__main__":
    main()
