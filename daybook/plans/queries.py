"""Registered queries: each runs a warehouse operator over the driver's tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame (nothing is
collected).  The matching DuckDB statements live in ``plans.oracle``.
JSON documents and CSV lines are made and parsed within one plan; the whole
build (``built_extended``) lands files in the shared scratch folder first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import (
    asof_join,
    asset_dimension,
    calendar_rows,
    cik_map,
    currency_pairs,
    daily_fx,
    daily_prices,
    equity_extended,
    missing_filings,
    open_days,
    shares_outstanding,
    table_report,
)
from daybook.operators.trading_days import date_spine_between
from daybook.plans.build import build_all
from daybook.plans.versions import publish, read_table
from daybook.session import scratch_path
from daybook.sources import (
    accepted_fx,
    currency_pairs_of_lines,
    flatten_cik_documents,
    fx_lines,
    parse_company_facts,
    price_history_of_lines,
    rejected_fx,
    tickers_of_lines,
)
from daybook.sources import testdata as td


#: Ticks a range of the hot ticker aims at; the library's default suits real sizes.
HOT_TICKER_SPLIT = 2_000


def q_asset_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticker list comes as the lines of a CSV file."""
    return asset_dimension(tickers_of_lines(td.ticker_list_lines(spark, sf_dir)))


def q_cik_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cik_map(td.cik_entries_by_name(spark, sf_dir))


def q_cik_map_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same map, with the entries as company→CIK JSON objects, parsed in the plan."""
    docs = td.cik_documents(td.cik_entries_by_name(spark, sf_dir)).withColumnRenamed("part", "doc")
    return cik_map(flatten_cik_documents(docs))


def q_currency_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair list comes as the lines of a CSV file."""
    return currency_pairs(currency_pairs_of_lines(td.pair_list_lines(spark, sf_dir)))


def q_daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_prices(
        td.price_history(spark, sf_dir), td.tickers_by_part(spark, sf_dir), td.PRICE_START, td.PRICE_END
    )


def q_daily_prices_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices for a list that names some tickers twice: their rows come twice."""
    return daily_prices(
        td.price_history(spark, sf_dir), td.tickers_repeated(spark, sf_dir), td.PRICE_START, td.PRICE_END
    )


def q_daily_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_fx(td.fx_history(spark, sf_dir), q_currency_pairs(spark, sf_dir), td.FX_START, td.FX_END)


def q_daily_prices_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices from per-ticker CSV lines whose headers differ from file to file."""
    history = price_history_of_lines(td.price_csv_lines(spark, sf_dir))
    return daily_prices(history, td.tickers_by_part(spark, sf_dir), td.PRICE_START, td.PRICE_END)


def q_daily_fx_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rates from per-symbol CSV lines, some of them damaged."""
    history = accepted_fx(fx_lines(td.fx_csv_lines(spark, sf_dir)))
    return daily_fx(history, td.currency_pairs_frame(spark, sf_dir), td.FX_START, td.FX_END)


def q_fx_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged lines, with what is wrong with each."""
    return rejected_fx(fx_lines(td.fx_csv_lines(spark, sf_dir)))


def _shares(spark: SparkSession, sf_dir: str, facts: DataFrame) -> DataFrame:
    return shares_outstanding(
        facts,
        td.tickers_by_part(spark, sf_dir),
        cik_map(td.cik_entries_by_part(spark, sf_dir)),
        td.FILING_START,
        td.FILING_END,
        td.TESTDATA_CONCEPTS,
    )


def q_shares_outstanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(spark, sf_dir, td.filing_facts(spark, sf_dir))


def q_shares_outstanding_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same selection, with the facts as company-facts JSON documents, parsed in the plan."""
    docs = td.facts_documents(td.numbered_filing_facts(spark, sf_dir))
    return _shares(spark, sf_dir, parse_company_facts(docs, td.TESTDATA_CONCEPTS))


def q_asof_market_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equity_extended(q_daily_prices(spark, sf_dir), q_shares_outstanding(spark, sf_dir), few_a_day=True)


def q_asof_market_cap_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with the two-level (per ticker-month) forward fill."""
    return equity_extended(
        q_daily_prices(spark, sf_dir),
        q_shares_outstanding(spark, sf_dir),
        bucket=lambda k: (k / 100).cast("int"),
        few_a_day=True,
    )


def q_built_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extended table as a whole build from landed files published it.

    The inputs land as files in the shared scratch folder, all seven tables are
    built and published from them, and the published version is read.
    """
    landing, warehouse = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    td.land_files(spark, sf_dir, landing)
    build_all(spark, landing, warehouse, td.PRICE_START, td.FX_END, facts_json_lines=True, versioned=True, concepts=td.LANDED_CONCEPTS)
    return read_table(spark, f"{warehouse}/equity_table_extended")


def q_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extended table over quotes with many rows per ticker-day (collapsed to one)."""
    return equity_extended(td.event_quotes(spark, sf_dir), td.event_signups(spark, sf_dir))


def q_latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extended table over orders keyed by (customer, order day), which repeats."""
    return equity_extended(td.order_quotes(spark, sf_dir), td.finished_orders(spark, sf_dir))


#: Files of the bucketed tables of ``asof_market_cap_bucketed``.
TICKER_BUCKETS = 16


def q_asof_market_cap_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship from published daily and filing tables that are bucketed by ticker and sorted by day."""
    layout = {"sort_within": ["ticker", "date_key"], "buckets": (TICKER_BUCKETS, ["ticker"])}
    daily, filings = scratch_path(spark, "daily_table"), scratch_path(spark, "edgar_10q_table")
    publish(q_daily_prices(spark, sf_dir), daily, **layout)
    publish(q_shares_outstanding(spark, sf_dir), filings, **layout)
    return equity_extended(read_table(spark, daily), read_table(spark, filings), by_ticker=True)


def q_asof_hot_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick with the latest purchase of its ticker up to its time; one ticker has half of all ticks.

    The carry of such a ticker is split into ranges of its own times.
    """
    ticks = td.event_ticks(spark, sf_dir)
    bought = ticks.where(F.col("event_type") == "purchase").select(
        "ticker", F.col("ts").alias("bought_at"), F.col("value").alias("paid"), F.col("event_id").alias("purchase_id"))
    joined = asof_join(
        ticks.select("ticker", "ts", "event_id"), bought, by="ticker", left_on="ts", right_on="bought_at",
        payload=["paid", "purchase_id"], matched_key="purchase_ts", split_rows=HOT_TICKER_SPLIT)
    # As text, which reads the same in every engine.
    return joined.withColumns({c: F.col(c).cast("string") for c in ("ts", "purchase_ts")})


def q_trading_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the order-date range of ``orders`` (bounds found by Spark)."""
    bounds = td.table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    )
    return calendar_rows(date_spine_between(bounds, "lo", "hi"))


def q_trading_calendar_event_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the whole years that ``events`` covers (2024)."""
    return calendar_rows(date_spine_between(td.event_years(spark, sf_dir), "lo", "hi"))


def q_open_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_days(q_trading_calendar(spark, sf_dir))


def q_missing_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_filings(q_asof_market_cap(spark, sf_dir))


def q_coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    extended = table_report(
        q_asof_market_cap(spark, sf_dir),
        "equity_table_extended",
        F.col("edgar_shares_outstanding").isNull(),
    )
    calendar = table_report(q_trading_calendar(spark, sf_dir), "date_table", F.col("nasdaq_open"))
    return extended.unionByName(calendar)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "asof_market_cap": q_asof_market_cap,
    "asof_market_cap_monthly": q_asof_market_cap_monthly,
    "asof_market_cap_bucketed": q_asof_market_cap_bucketed,
    "asof_hot_ticker": q_asof_hot_ticker,
    "shares_outstanding": q_shares_outstanding,
    "shares_outstanding_json": q_shares_outstanding_json,
    "daily_prices": q_daily_prices,
    "daily_prices_repeated": q_daily_prices_repeated,
    "daily_prices_csv": q_daily_prices_csv,
    "daily_fx": q_daily_fx,
    "daily_fx_csv": q_daily_fx_csv,
    "fx_rejects": q_fx_rejects,
    "currency_pairs": q_currency_pairs,
    "cik_map": q_cik_map,
    "cik_map_json": q_cik_map_json,
    "asset_dimension": q_asset_dimension,
    "trading_calendar": q_trading_calendar,
    "trading_calendar_event_years": q_trading_calendar_event_years,
    "open_days": q_open_days,
    "built_extended": q_built_extended,
    "latest_per_key": q_latest_per_key,
    "latest_per_customer": q_latest_per_customer,
    "missing_filings": q_missing_filings,
    "coverage_report": q_coverage_report,
}
