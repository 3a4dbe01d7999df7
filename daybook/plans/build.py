"""Build every warehouse table from landed files, in dependency order.

Landing folder layout (all optional except what a table needs)::

    tickers.csv            ticker list (header ``ticker``)
    currency_pairs.csv     ``currency,transaction_currency``
    company_tickers.json   company→CIK document(s)
    companyfacts/          company-facts JSON, one document per file (or JSON Lines)
    prices/                price history: Parquet (ticker, day, open, high, low, close, volume),
                           or with history_format="csv": one <TICKER>.csv per ticker
                           (Date,Open,High,Low,Close,Volume,...)
    fx/                    FX history: Parquet (symbol, day, close), or one <SYMBOL>.csv
                           per symbol (Date,...,Close,...), e.g. USDJPY=X.csv

Order: calendar; assets → {daily prices, filings} → extended; pairs → daily
FX.  ``tables`` selects a narrower run (``EQUITY_TABLES``, ``DATE_TABLES``);
what a selected table needs is built first.  A table's jobs are submitted as
soon as what it needs is written, so independent branches share the cluster
(one FAIR pool each, see ``run_graph``).  The extended table reads the
*written* daily and filing tables, so its job starts from files in the shared
output folder (lineage is cut, and a lost executor only recomputes the last
job).
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from daybook.operators import (
    asset_dimension,
    cik_map,
    currency_pairs,
    daily_fx,
    daily_prices,
    equity_extended,
    shares_outstanding,
    trading_calendar,
)
from daybook.operators.filings import SHARE_CONCEPTS
from daybook.plans import versions
from daybook.plans.sinks import with_year, write_counted, write_table
from daybook.schemas import (
    ASSET_TABLE,
    CURRENCY_PAIRS_TABLE,
    DAILY_CURRENCY_TABLE,
    DAILY_TABLE,
    DATE_TABLE,
    EQUITY_EXTENDED_TABLE,
    FX_REJECTS,
    SHARES_TABLE,
)
from daybook.session import scratch_path
from daybook.sources import (
    accepted_fx,
    csv_lines,
    fx_lines,
    read_cik_document,
    read_company_facts,
    read_currency_pairs,
    read_fx_history,
    read_price_history,
    read_price_history_csv_per_ticker,
    read_tickers,
    rejected_fx,
)

# The warehouse tables in a valid build order, what each needs
# built first, and the two narrower runs (equity tables, calendar only).
TABLES = [
    "date_table",
    "asset_table",
    "currency_pairs_table",
    "daily_table",
    "edgar_10q_table",
    "daily_currency_table",
    "equity_table_extended",
]
DEPENDS_ON = {
    "date_table": [],
    "asset_table": [],
    "currency_pairs_table": [],
    "daily_table": ["asset_table"],
    "edgar_10q_table": ["asset_table"],
    "daily_currency_table": ["currency_pairs_table"],
    "equity_table_extended": ["daily_table", "edgar_10q_table"],
}
EQUITY_TABLES = ["asset_table", "daily_table", "edgar_10q_table", "equity_table_extended"]
DATE_TABLES = ["date_table"]


def build_order(tables: list[str] | None = None, with_dependencies: bool = True) -> list[str]:
    """The tables to build, in dependency order."""
    wanted = set(TABLES if tables is None else tables)
    unknown = wanted - set(TABLES)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    if with_dependencies:
        todo = list(wanted)
        while todo:
            for dep in DEPENDS_ON[todo.pop()]:
                if dep not in wanted:
                    wanted.add(dep)
                    todo.append(dep)
    return [t for t in TABLES if t in wanted]


class BuildFailed(RuntimeError):
    """Some tables could not be built.

    ``report``: counts of the tables that were; ``failures``: the exception of each
    that failed; ``skipped``: tables left out because they need a failed one.
    """

    def __init__(self, report: dict, failures: dict[str, BaseException], skipped: list[str]):
        what = "; ".join(f"{name}: {error}" for name, error in failures.items())
        super().__init__(what + (f" (not built for it: {', '.join(skipped)})" if skipped else ""))
        self.report, self.failures, self.skipped = report, failures, skipped


def run_graph(
    builders: dict[str, Callable[[], dict]],
    depends_on: dict[str, list[str]],
    spark: SparkSession | None = None,
    at_once: int | None = None,
) -> dict[str, dict]:
    """Call ``builders``, each once all it depends on is done, independent ones at once.

    Returns their results in the order of ``builders``.  A failure stops only what
    depends on it: the rest is built, then ``BuildFailed`` tells all three.  Dependencies
    that are no builder count as there already.  The calls only submit Spark jobs; with
    ``spark`` each runs in a FAIR pool of its own name, so that a long table does not
    hold up a short one (``spark.scheduler.mode`` decides whether pools count).
    """
    todo = {name: {d for d in depends_on.get(name, []) if d in builders} for name in builders}
    done, failures, skipped = {}, {}, []
    running: dict[Future, str] = {}

    def call(name: str) -> dict:
        sc = _context(spark)
        if sc is not None:
            sc.setLocalProperty("spark.scheduler.pool", name)
            sc.setLocalProperty("spark.job.description", f"build {name}")
        return builders[name]()

    with ThreadPoolExecutor(max_workers=at_once or len(builders) or 1, thread_name_prefix="build") as pool:
        while todo or running:
            for name in [n for n, needs in todo.items() if needs & (failures.keys() | set(skipped))]:
                skipped.append(name)
                todo.pop(name)
            ready = [n for n, needs in todo.items() if needs <= done.keys()]
            for name in ready:
                todo.pop(name)
                running[pool.submit(call, name)] = name
            if not running:
                if todo and not any(needs & (failures.keys() | set(skipped)) for needs in todo.values()):
                    raise ValueError(f"tables that depend on each other: {sorted(todo)}")
                continue
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in finished:
                name = running.pop(future)
                error = future.exception()
                if error is None:
                    done[name] = future.result()
                else:
                    failures[name] = error
    report = {name: done[name] for name in builders if name in done}
    if failures:
        raise BuildFailed(report, failures, [n for n in builders if n in skipped]) from next(iter(failures.values()))
    return report


def _context(spark: SparkSession | None):
    """The session's SparkContext; None without session or on Spark Connect."""
    try:
        return spark.sparkContext if spark is not None else None
    except Exception:
        return None


def build_all(
    spark: SparkSession,
    landing: str,
    out: str,
    start: date,
    end: date,
    partition_by_year: bool = False,
    tables: list[str] | None = None,
    with_dependencies: bool = True,
    history_format: str = "parquet",
    facts_json_lines: bool = False,
    versioned: bool = False,
    buckets: int | None = None,
    concepts: list[str] = SHARE_CONCEPTS,
    at_once: int | None = None,
) -> dict[str, dict[str, int]]:
    """Build the tables (all, or ``tables`` and what they need); return the
    per-table counts gathered during the writes.

    With ``versioned`` every table is published as a version (``plans.versions``:
    replaced in one atomic step, read by ``read_table``), else written as plain
    files at its path.  With ``buckets`` (and ``versioned``) the daily and filing
    tables are bucketed by ticker and sorted by day, and the extended table is
    made from them without a shuffle.  ``concepts`` are the share-count concepts in order of
    preference; ``at_once`` bounds how many tables are built at a time.  Of FX
    histories in CSV, the lines left out become the table
    ``daily_currency_rejects`` and are counted as ``rejected_lines``.  Tables that
    fail stop only what needs them; ``BuildFailed`` then has the report of the rest.

    Without ``with_dependencies`` the tables a requested table reads must
    already exist under ``out``.  ``facts_json_lines`` reads company facts
    as JSON Lines (one document per line, e.g. after a bulk conversion)
    instead of one document per file.
    """
    if buckets and (not versioned or partition_by_year):
        raise ValueError("buckets need versioned tables that are not partitioned by year")
    by_ticker = {"buckets": (buckets, ["ticker"])} if buckets else {}

    def path(name):
        return os.path.join(out, name)

    def land(name):
        return os.path.join(landing, name)

    def part(df):
        return (with_year(df), ["year"]) if partition_by_year else (df, None)

    def written(name):
        df = versions.read_table(spark, path(name))
        return df.drop("year") if "year" in df.columns else df

    def write(df, name, *args, **kwargs):
        sink = versions.publish if versioned else write_table
        return sink(df, path(name), *args, **kwargs)

    def tickers():
        return read_tickers(spark, land("tickers.csv"))

    def build_date_table():
        return write(
            trading_calendar(spark, start, end),
            "date_table",
            {"open_days": F.col("nasdaq_open")},
            sort_within=["date_key"],
            contract=DATE_TABLE,
        )

    def build_asset_table():
        return write(asset_dimension(tickers()), "asset_table", contract=ASSET_TABLE)

    def build_currency_pairs_table():
        pairs = currency_pairs(read_currency_pairs(spark, land("currency_pairs.csv")))
        return write(pairs, "currency_pairs_table", contract=CURRENCY_PAIRS_TABLE)

    if history_format not in ("parquet", "csv"):
        raise ValueError("history_format must be 'parquet' or 'csv'")

    def price_history():
        if history_format == "csv":
            return read_price_history_csv_per_ticker(spark, land("prices"))
        return read_price_history(spark, land("prices"))

    def fx_history():
        """FX history and the number of lines left out (None for Parquet)."""
        if history_format != "csv":
            return read_fx_history(spark, land("fx")), None
        # The files are read once; good and rejected lines are told apart in what is kept of them.
        staged = scratch_path(spark, "fx_lines")
        parsed = fx_lines(csv_lines(spark, land("fx"))).withColumn("rejected", F.col("reason").isNotNull())
        counts = write_counted(parsed, staged, {"rejected": F.col("rejected")}, partition_by=["rejected"])
        kept = spark.read.schema(parsed.schema).parquet(staged)
        write(rejected_fx(kept.where("rejected")), "daily_currency_rejects", contract=FX_REJECTS)
        return accepted_fx(kept.where("NOT rejected")), counts["rejected"]

    def build_daily_table():
        df, by = part(daily_prices(price_history(), tickers(), start, end))
        return write(
            df, "daily_table", partition_by=by, sort_within=["ticker", "date_key"],
            contract=DAILY_TABLE, **by_ticker,
        )

    def build_edgar_10q_table():
        filings = shares_outstanding(
            read_company_facts(spark, land("companyfacts"), multi_line=not facts_json_lines, concepts=concepts),
            tickers(),
            cik_map(read_cik_document(spark, land("company_tickers.json"))),
            start,
            end,
            concepts,
        )
        return write(
            filings, "edgar_10q_table", sort_within=["ticker", "date_key"],
            contract=SHARES_TABLE, **by_ticker,
        )

    def build_daily_currency_table():
        history, rejected = fx_history()
        df, by = part(daily_fx(history, written("currency_pairs_table"), start, end))
        counts = write(
            df,
            "daily_currency_table",
            partition_by=by,
            sort_within=["currency", "transaction_currency", "date_key"],
            contract=DAILY_CURRENCY_TABLE,
        )
        return counts if rejected is None else counts | {"rejected_lines": rejected}

    def build_equity_table_extended():
        # Reads the written daily and filing tables: lineage starts at files.
        df, by = part(equity_extended(written("daily_table"), written("edgar_10q_table"), by_ticker=bool(buckets)))
        return write(
            df,
            "equity_table_extended",
            {"missing_filing": F.col("edgar_shares_outstanding").isNull()},
            partition_by=by,
            sort_within=["ticker", "date_key"],
            contract=EQUITY_EXTENDED_TABLE,
        )

    builders = {
        "date_table": build_date_table,
        "asset_table": build_asset_table,
        "currency_pairs_table": build_currency_pairs_table,
        "daily_table": build_daily_table,
        "edgar_10q_table": build_edgar_10q_table,
        "daily_currency_table": build_daily_currency_table,
        "equity_table_extended": build_equity_table_extended,
    }
    return run_graph({name: builders[name] for name in build_order(tables, with_dependencies)}, DEPENDS_ON, spark, at_once)
