"""The extended daily equity table: latest filing per price row + market cap."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.asof import filled_by_bucket

DAILY_COLUMNS = [
    "ticker", "source", "date_key",
    "stock_open", "stock_high", "stock_low", "stock_close", "volume",
]


def one_row_per_ticker_day(daily: DataFrame) -> DataFrame:
    """Keep one price row per (ticker, date_key).

    The extended table is keyed by (ticker, date_key) and ignores ``source``:
    two sources (or a ticker listed twice) collapse to one row.  The row kept
    is the first by ``source`` and then every measure, so the choice is
    deterministic.  Planned as a top-1 window; Spark applies the limit
    partially before the shuffle, so duplicates are dropped map-side.
    """
    order = [F.col(c).asc_nulls_first() for c in DAILY_COLUMNS if c not in ("ticker", "date_key")]
    w = Window.partitionBy("ticker", "date_key").orderBy(*order)
    return (
        daily.select(*DAILY_COLUMNS)
        .withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .drop("__rn")
    )


def equity_extended(
    daily: DataFrame,
    filings: DataFrame,
    bucket: Callable[[Column], Column] | None = None,
    by_ticker: bool = False,
    few_a_day: bool = False,
) -> DataFrame:
    """T7: every daily row with the filing of greatest ``date_key`` on or before it.

    ``filings`` has the shares-table contract (ticker, cik, date_key,
    shares_outstanding).  ``market_cap = stock_close × shares`` (NULL without a
    filing).  The filing is keyed by period end, so figures are used from the
    period end on, and prices are split-adjusted while share counts are as
    reported; both are properties of the inputs, kept as they are.
    Rows are reduced to one per (ticker, date_key) first, so daily rows and
    filings can share one window per ticker, bounded by its days.  With
    ``bucket`` they share the two-level forward fill of ``asof_join`` instead.
    With ``by_ticker`` every row looks its filing up among its ticker's own: on
    tables bucketed by ticker (``plans.versions``) nothing is shuffled, at the
    price of comparing a row with each filing of its ticker.
    ``few_a_day`` says that a (ticker, date_key) has a few daily rows at most (its
    sources and listings): rows then move once, by ticker (and bucket), and are sorted
    once for each reading.  Without it rows that come many to a key are reduced before
    they move.  The result is the same.
    """
    if by_ticker:
        if bucket is not None:
            raise ValueError("either bucket or by_ticker")
        return _priced(_looked_up(one_row_per_ticker_day(daily), filings))
    return _priced(_carried(daily, filings, bucket, few_a_day))


def _carried(daily: DataFrame, filings: DataFrame, bucket: Callable[[Column], Column] | None, few_a_day: bool) -> DataFrame:
    """One daily row per (ticker, date_key) with the latest filing, from one grouping of both and one window (with ``bucket`` two).

    Of several daily rows of a key the first by source and then the measures stays, as
    in ``one_row_per_ticker_day``.
    """
    day = daily.schema["date_key"].dataType
    row = F.struct(*[F.col(c) for c in DAILY_COLUMNS if c not in ("ticker", "date_key")])
    filing = F.struct(
        F.col("date_key").cast(day).alias("edgar_10q_date_key"),
        F.col("shares_outstanding").alias("edgar_shares_outstanding"),
        F.col("cik").alias("edgar_cik"))
    filed = filings.where(F.col("ticker").isNotNull() & F.col("date_key").isNotNull()).select(
        "ticker", F.col("date_key").cast(day).alias("date_key"), filing.alias("__filing"))
    both = daily.select("ticker", "date_key", row.alias("__row")).unionByName(filed, allowMissingColumns=True)
    dealt = ["ticker"] if bucket is None else ["ticker", "__bucket"]
    if few_a_day:
        # The grouping and what follows take this layout as it is.
        both = both.repartition("ticker", *([] if bucket is None else [bucket(F.col("date_key"))]))
    if bucket is not None:
        both = both.withColumn("__bucket", bucket(F.col("date_key")))
    # Structs compare field by field, NULLs first; a key's filing is visible to its own day.
    keys = both.groupBy(*dealt, "date_key").agg(F.min("__row").alias("__row"), F.max("__filing").alias("__filing"))
    if bucket is not None:
        filled = filled_by_bucket(keys if few_a_day else keys.repartition(*dealt), "ticker", "date_key", "__filing", "__row", "__bucket")
    else:
        order = Window.partitionBy("ticker").orderBy("date_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filled = keys.withColumn("__filing", F.last("__filing", ignorenulls=True).over(order)).where(F.col("__row").isNotNull())
    return filled.select("ticker", "date_key", "__row.*", "__filing.*")


def _looked_up(daily: DataFrame, filings: DataFrame) -> DataFrame:
    """Daily rows with the latest filing, from one array per ticker (a ticker has at most one filing a day there)."""
    day = daily.schema["date_key"].dataType
    own = (
        filings.where(F.col("ticker").isNotNull() & F.col("date_key").isNotNull())
        .groupBy("ticker").agg(F.array_sort(F.collect_set(F.struct(
            F.col("date_key").cast(day).alias("edgar_10q_date_key"),
            F.col("shares_outstanding").alias("edgar_shares_outstanding"),
            F.col("cik").alias("edgar_cik")))).alias("__filings"))
    )
    joined = daily.join(own, "ticker", "left")
    # Of equal days the largest filing is last, as in the carry.
    latest = F.get(F.reverse(F.filter("__filings", lambda f: f["edgar_10q_date_key"] <= F.col("date_key"))), F.lit(0))
    return joined.withColumn("__filing", latest).select(*DAILY_COLUMNS, "__filing.*")


def _priced(joined: DataFrame) -> DataFrame:
    return joined.select(
        *DAILY_COLUMNS,
        F.col("edgar_shares_outstanding"),
        (F.col("stock_close") * F.col("edgar_shares_outstanding")).alias("market_cap"),
        F.col("edgar_10q_date_key").cast("int").alias("edgar_10q_date_key"),
        F.col("edgar_cik"),
    )
