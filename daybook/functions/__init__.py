"""Column expressions shared by the operators (all JVM-side, codegen-able)."""

from daybook.functions.keys import (
    DAY_NAMES,
    as_col,
    date_key,
    day_name,
    exchange_day,
    filed_key,
    iso_key,
    truncate_to_long,
    zero_pad_cik,
)

__all__ = [
    "DAY_NAMES",
    "as_col",
    "date_key",
    "day_name",
    "exchange_day",
    "filed_key",
    "iso_key",
    "truncate_to_long",
    "zero_pad_cik",
]
