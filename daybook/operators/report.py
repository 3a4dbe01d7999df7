"""Build reports: row counts and conditional counts as one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_report(df: DataFrame, table: str, flagged: Column) -> DataFrame:
    """One row ``table, total_rows, flagged_rows`` in a single pass.

    E.g. open days of the calendar (``nasdaq_open``) or extended rows without
    a filing (``edgar_shares_outstanding IS NULL``).
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(flagged).alias("flagged_rows"),
    ).select(F.lit(table).alias("table"), "total_rows", "flagged_rows")


def missing_filings(extended: DataFrame) -> DataFrame:
    """Extended rows with no filing on or before their day."""
    return extended.where(F.col("edgar_shares_outstanding").isNull())


def open_days(calendar: DataFrame) -> DataFrame:
    """Calendar rows on which the exchange is open."""
    return calendar.where(F.col("nasdaq_open"))
