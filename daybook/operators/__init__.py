"""Operators: DataFrame → DataFrame functions, one per warehouse table."""

from daybook.operators.asof import asof_join
from daybook.operators.dims import asset_dimension, cik_map, currency_pairs, dense_index
from daybook.operators.extended import equity_extended, one_row_per_ticker_day
from daybook.operators.facts import daily_fx, daily_prices
from daybook.operators.filings import select_filings, shares_outstanding
from daybook.operators.report import missing_filings, open_days, table_report
from daybook.operators.trading_days import calendar_rows, date_spine, trading_calendar

__all__ = [
    "asof_join",
    "asset_dimension",
    "calendar_rows",
    "cik_map",
    "currency_pairs",
    "daily_fx",
    "daily_prices",
    "date_spine",
    "dense_index",
    "equity_extended",
    "missing_filings",
    "one_row_per_ticker_day",
    "open_days",
    "select_filings",
    "shares_outstanding",
    "table_report",
    "trading_calendar",
]
