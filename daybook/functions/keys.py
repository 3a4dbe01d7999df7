"""Key and value conversions.

Time is an integer ``date_key`` of the form YYYYMMDD throughout the
warehouse.  All conversions are built-in expressions; parsing that may fail
uses ``try_cast`` because ANSI mode (the Spark 4 default) turns a failed
``cast`` into an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case English day names, Monday first, the contract of
# the calendar table's ``day_of_week`` column.
DAY_NAMES = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: Column | str) -> Column:
    """DATE / TIMESTAMP → int YYYYMMDD (zone-less timestamps keep their day)."""
    d = F.to_date(as_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def exchange_day(ts: Column | str, tz: str = "America/New_York") -> Column:
    """The exchange-local calendar day of a UTC instant (for landed UTC timestamps)."""
    return F.to_date(F.from_utc_timestamp(as_col(ts), tz))


def day_name(d: Column | str) -> Column:
    """Locale-proof lower-case English day name of a date."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.weekday(as_col(d)) + 1)


# An integer literal as Python's ``int()`` reads it (ASCII
# whitespace around, optional plus sign, single underscores between digits).
_INT_TEXT = r"^[ \t\n\r\x0b\x0c]*\+?[0-9]+(_[0-9]+)*[ \t\n\r\x0b\x0c]*$"
_INT_NOISE = r"[ \t\n\r\x0b\x0c_+]"
KEY_TYPE = "decimal(38,0)"


def iso_key(s: Column | str) -> Column:
    """ISO-like text → integer key by dropping dashes; NULL when it does not parse.

    ``'2024-03-31'`` → 20240331.  Malformed but numeric text keeps its digits
    (``'2024-3-1'`` → 202431), exactly like dropping dashes and reading an
    int.  The result is a wide decimal, so an over-long value stays a (large)
    key instead of overflowing; callers compare it with int keys directly.
    """
    digits = F.regexp_replace(as_col(s), "-", "")
    return F.when(
        digits.rlike(_INT_TEXT), F.regexp_replace(digits, _INT_NOISE, "").try_cast(KEY_TYPE)
    )


def filed_key(s: Column | str) -> Column:
    """Filing-date key: missing or empty text → 0, unparsable → NULL."""
    s = as_col(s)
    return F.when(s.isNull() | (s == ""), F.lit(0).cast(KEY_TYPE)).otherwise(iso_key(s))


def zero_pad_cik(c: Column | str) -> Column:
    """Left-pad a CIK with zeros to 10 characters; longer values stay whole.

    Like Python's ``str.zfill(10)``: a leading sign stays in front of the
    zeros.
    """
    s = as_col(c).cast("string")
    signed = s.startswith("-") | s.startswith("+")
    return (
        F.when(F.length(s) >= 10, s)
        .when(signed, F.concat(F.substring(s, 1, 1), F.lpad(F.substring(s, 2, 10), 9, "0")))
        .otherwise(F.lpad(s, 10, "0"))
    )


def truncate_to_long(c: Column | str) -> Column:
    """A numeric value (number or numeric text) → long, truncated toward zero.

    Text goes through an exact decimal so ``'15000000000'`` and ``'1.5E10'``
    stay exact; unparsable text becomes NULL.
    """
    c = as_col(c)
    return c.try_cast("decimal(38,9)").cast("long")
