"""Sources: readers of landed files, and adapters over the driver's testdata."""

from daybook.sources.csv_files import (
    accepted_fx,
    bind_by_header,
    csv_lines,
    currency_pairs_of_lines,
    fx_lines,
    price_history_of_lines,
    rejected_fx,
    tickers_of_lines,
)
from daybook.sources.landed import (
    flatten_company_facts,
    flatten_cik_documents,
    parse_company_facts,
    read_cik_document,
    read_company_facts,
    read_currency_pairs,
    read_fx_history,
    read_fx_history_csv_per_symbol,
    read_price_history,
    read_price_history_csv_per_ticker,
    read_tickers,
)

__all__ = [
    "accepted_fx",
    "bind_by_header",
    "csv_lines",
    "currency_pairs_of_lines",
    "fx_lines",
    "price_history_of_lines",
    "rejected_fx",
    "flatten_company_facts",
    "flatten_cik_documents",
    "parse_company_facts",
    "read_cik_document",
    "read_company_facts",
    "read_currency_pairs",
    "read_fx_history",
    "read_fx_history_csv_per_symbol",
    "read_price_history",
    "read_price_history_csv_per_ticker",
    "read_tickers",
    "tickers_of_lines",
]
