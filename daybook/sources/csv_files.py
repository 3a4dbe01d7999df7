"""CSV files that each have their own header.

``spark.read.csv(folder, header=True)`` takes one file's header for all and binds
the rest by position: files that list the same columns in another order are read
wrong, without an error.  Here every file keeps its own: its lines are read as
text, its header is the first line that holds all required names, and a field is
looked up at the place its name has in the file's own header.

Plan: a small frame of headers (one row per file) is joined to the lines on the
file's path.  The headers are computed once (a reliable checkpoint) and broadcast
only if their measured size is within ``BROADCAST_BYTES``; beyond it Spark joins
by shuffle and splits a file that holds most lines.  Parsing is built-in
expressions over the line; nothing is collected but that size.

Fields may be quoted (a doubled quote stands for one) but hold no line breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import checkpoint_root

#: Headers up to this many bytes go to every executor.
BROADCAST_BYTES = 64 << 20
_FIELD = r',("(?:[^"]|"")*"|[^,]*)'


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, value``: the lines of all files of a folder; ``line`` grows within a file."""
    text = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"), "value")
    return text.select("file", F.struct("start", "row").alias("line"), "value")


def fields(line: Column) -> Column:
    """The fields of a CSV line, unquoted, as an array."""
    def bare(field: Column) -> Column:
        inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
        return F.when(field.startswith('"') & field.endswith('"') & (F.length(field) > 1), inner).otherwise(field)

    whole = F.rtrim(line, F.lit("\r"))
    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), whole), F.lit(_FIELD), F.lit(1)), bare)
    return F.when(F.contains(whole, F.lit('"')), quoted).otherwise(F.split(whole, ",", -1))


def file_headers(lines: DataFrame, names: list[str]) -> DataFrame:
    """``file, header_line`` and the 1-based place of each name, for the files that have a header with all ``names``."""
    cells = F.transform(fields(F.ltrim(F.col("value"), F.lit("﻿"))), lambda c: F.trim(c))
    # Cheap test first: few lines hold every name anywhere.
    likely = F.lit(True)
    for name in names:
        likely = likely & F.contains(F.col("value"), F.lit(name))
    rows = lines.where(likely).select("file", "line", cells.alias("cells"))
    rows = rows.where(F.size(F.array_except(F.array(*[F.lit(n) for n in names]), "cells")) == 0)
    first = rows.groupBy("file").agg(F.min("line").alias("header_line"), F.min_by("cells", "line").alias("cells"))
    return first.select("file", "header_line", *[F.array_position("cells", n).cast("int").alias(f"at_{k}") for k, n in enumerate(names)])


def bind_by_header(lines: DataFrame, names: list[str], broadcast_bytes: int = BROADCAST_BYTES, parse_once: bool = False) -> DataFrame:
    """``file, value, headed`` and one text column per name, for every line but headers and blank lines.

    ``headed`` says whether the line's file has a header with all names; if not,
    the columns are NULL, as they are for a line that is too short.  With
    ``parse_once`` callers' filters stay above the parse (``once``): for many lines.
    """
    checkpoint_root(lines.sparkSession)
    headers = file_headers(lines, names).checkpoint(eager=True)
    width = 12 + 4 * len(names)
    size = headers.agg(F.sum(F.octet_length("file") + width)).first()[0] or 0
    side = F.broadcast(headers) if size <= broadcast_bytes else headers
    joined = lines.join(side, "file", "left")
    is_data = F.col("header_line").isNull() | (F.col("line") != F.col("header_line"))
    filled = F.trim(F.rtrim("value", F.lit("\r"))) != ""
    if parse_once:
        kept = ["file", "line", "value", *headers.columns[1:]]
        parsed = once(joined.where(is_data), kept, filled.alias("filled"), fields(F.col("value")).alias("cells")).where("filled")
        cells = F.col("cells")
    else:
        parsed, cells = joined.where(filled & is_data), fields(F.col("value"))
    # A header's own cells are NULL too: Spark may test a caller's filter on them before it drops the header line.
    return parsed.select(
        "file", "value", F.col("header_line").isNotNull().alias("headed"),
        *[F.get(cells, F.when(is_data, F.col(f"at_{k}") - 1)).alias(n) for k, n in enumerate(names)])


def once(rows: DataFrame, kept: list[str], *made: Column) -> DataFrame:
    """``rows`` with ``kept`` and the ``made`` columns, which are computed once a row.

    One struct a row, exploded, is a fence: else Spark moves filters on what was made
    below it, where each of their mentions computes it (and what it was made from) anew.
    """
    return rows.select(*kept, F.explode(F.array(F.struct(*made))).alias("__made")).select(*kept, "__made.*")


def base_name(file: Column) -> Column:
    """File name without folder and extension (``.../AAPL.csv`` → ``AAPL``)."""
    return F.regexp_extract(file, r"([^/]+)\.[^./]+$", 1)


def tickers_of_lines(lines: DataFrame) -> DataFrame:
    """``ticker`` of the lines (``file, line, value``) of ticker lists; other columns are ignored.

    A list without a ``ticker`` header fails the read.
    """
    return _headed(bind_by_header(lines, ["ticker"]), ["ticker"]).select("ticker")


def currency_pairs_of_lines(lines: DataFrame) -> DataFrame:
    """``currency, transaction_currency`` of the lines of pair lists, by the names in their headers.

    So a file whose header has the two swapped is read right; one without them fails.
    """
    names = ["currency", "transaction_currency"]
    return _headed(bind_by_header(lines, names), names).select(*names)


def _headed(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows``, failing on a file without header."""
    return rows.where(F.when(F.col("headed"), F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit(f"no header with {', '.join(names)}: "), "file")).cast("boolean")))


# The columns read of a price and of an FX file.
PRICE_COLUMNS = ["Date", "Open", "High", "Low", "Close", "Volume"]
FX_COLUMNS = ["Date", "Close"]


def price_history_of_lines(lines: DataFrame) -> DataFrame:
    """``PRICE_HISTORY`` rows of per-ticker CSV lines (``file, line, value``; the file's name is the ticker).

    The day is the one written at the start of ``Date``, i.e. exchange-local.  A file
    without a header that names all six columns fails the read, as does text that is
    no number: a price history is whole or not at all.
    """
    rows = _headed(bind_by_header(lines, PRICE_COLUMNS, parse_once=True), PRICE_COLUMNS)
    return once(
        rows, [], base_name(F.col("file")).alias("ticker"), F.to_date(F.substring("Date", 1, 10), "yyyy-MM-dd").alias("day"),
        *[F.col(c).cast("double").alias(c.lower()) for c in PRICE_COLUMNS[1:]])


def fx_lines(lines: DataFrame) -> DataFrame:
    """``symbol, day, close, file, value, reason`` of per-symbol CSV lines (``file, line, value``).

    Each line stands for itself: ``reason`` is NULL for a good one, else what is wrong
    with it, so that one bad line or pair does not take the others with it.
    """
    rows = bind_by_header(lines, FX_COLUMNS)
    day, close = F.substring("Date", 1, 10).try_cast("date"), F.col("Close").try_cast("double")
    reason = (
        F.when(~F.col("headed"), F.lit(f"no header with {', '.join(FX_COLUMNS)}"))
        .when(F.col("Date").isNull() | F.col("Close").isNull(), F.lit("too few fields"))
        .when(day.isNull(), F.lit("unreadable day"))
        .when(close.isNull(), F.lit("unreadable rate")))
    return rows.select(base_name(F.col("file")).alias("symbol"), day.alias("day"), close.alias("close"), "file", "value", reason.alias("reason"))


def accepted_fx(parsed: DataFrame) -> DataFrame:
    """``FX_HISTORY`` of the good lines of ``fx_lines``."""
    return parsed.where("reason IS NULL").select("symbol", "day", "close")


def rejected_fx(parsed: DataFrame) -> DataFrame:
    """``file, value, reason`` of the lines of ``fx_lines`` that were left out."""
    return parsed.where("reason IS NOT NULL").select("file", "value", "reason")
