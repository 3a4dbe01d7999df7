"""Daily price (T4) and daily FX (T6) facts from landed history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import date_key

# The source name stamped on every price row, and the unit of
# the base currency in every FX row.
PRICE_SOURCE = "yahoo_finance"
CURRENCY_UNIT = 1.0


def daily_prices(
    history: DataFrame,
    tickers: DataFrame,
    start: date,
    end: date,
    source: str = PRICE_SOURCE,
) -> DataFrame:
    """T4 from price history ``ticker, day, open, high, low, close, volume``.

    Days in ``[start, end)`` — the history source treats ``end`` as
    exclusive, unlike the calendar.  Only listed tickers, with the list's
    multiplicity (inner join, not a semi-join).  The day range is a plain
    filter on the scan column, so it reaches the Parquet reader.  How the list
    joins is left to Spark, which broadcasts it by its measured bytes.
    """
    window = history.where((F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(end)))
    rows = window.join(tickers.select("ticker"), "ticker")
    return rows.select(
        F.col("ticker"),
        F.lit(source).alias("source"),
        date_key("day").alias("date_key"),
        F.col("open").cast("double").alias("stock_open"),
        F.col("high").cast("double").alias("stock_high"),
        F.col("low").cast("double").alias("stock_low"),
        F.col("close").cast("double").alias("stock_close"),
        F.col("volume").cast("long").alias("volume"),
    )


def fx_symbol(currency, transaction_currency):
    """``USD`` + ``JPY`` → ``USDJPY=X``."""
    return F.concat(currency, transaction_currency, F.lit("=X"))


def daily_fx(history: DataFrame, pairs: DataFrame, start: date, end: date) -> DataFrame:
    """T6 from FX history ``symbol, day, close`` for each listed pair.

    Days in ``[start, end)``.  A pair without history yields no rows.
    """
    window = history.where((F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(end)))
    keyed = pairs.select(
        "currency",
        "transaction_currency",
        fx_symbol(F.col("currency"), F.col("transaction_currency")).alias("symbol"),
    )
    rows = keyed.join(window, "symbol")
    return rows.select(
        "currency",
        "transaction_currency",
        date_key("day").alias("date_key"),
        F.lit(CURRENCY_UNIT).alias("currency_unit"),
        F.col("close").cast("double").alias("transaction_currency_rate"),
    )
