"""Trading calendar (T1): every calendar day with its NASDAQ open/closed flag.

Each day's flag is a per-row expression (weekday, fixed-date holidays with
their weekend shift, nth-weekday holidays, Good Friday from the Gregorian
Easter date, and a short table of one-off closures), so the calendar needs no
join and no shuffle: it is a projection over a date spine.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import date_key, day_name

FIRST_SUPPORTED_YEAR = 1995

# One-off full-day closures of the US equity exchanges since 1995
# (Sept 11 attacks, national days of mourning, Hurricane Sandy).
SPECIAL_CLOSURES = [
    "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14",
    "2004-06-11",
    "2007-01-02",
    "2012-10-29", "2012-10-30",
    "2018-12-05",
    "2025-01-09",
]

# First year of holidays added later (MLK Day, Juneteenth).
MLK_DAY_FROM = 1998
JUNETEENTH_FROM = 2022


def _div(a: Column, n: int) -> Column:
    return F.floor(a / F.lit(n)).cast("int")


def easter_sunday(y: Column) -> Column:
    """Gregorian Easter Sunday of year ``y`` (anonymous Gregorian algorithm)."""
    a = y % 19
    b = _div(y, 100)
    c = y % 100
    d = _div(b, 4)
    e = b % 4
    f = _div(b + 8, 25)
    g = _div(b - f + 1, 3)
    h = (19 * a + b - d - g + 15) % 30
    i = _div(c, 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = _div(a + 11 * h + 22 * l_, 451)
    t = h + l_ - 7 * m + 114
    return F.make_date(y, _div(t, 31), t % 31 + 1)


def _fixed_observed(d: Column, y: Column, month: int, day: int, saturday_shift: bool = True) -> Column:
    """Fixed-date holiday: on the day if a weekday; Sunday → next Monday;
    Saturday → previous Friday (when ``saturday_shift``)."""
    h = F.make_date(y, F.lit(month), F.lit(day))
    wd = F.weekday(d)
    on_day = (d == h) & (wd < 5)
    monday_after_sunday = (wd == 0) & (F.date_sub(d, 1) == h)
    if not saturday_shift:
        return on_day | monday_after_sunday
    friday_before_saturday = (wd == 4) & (F.date_add(d, 1) == h)
    return on_day | monday_after_sunday | friday_before_saturday


def _nth_weekday(d: Column, month: int, weekday: int, n: int) -> Column:
    dom = F.dayofmonth(d)
    return (
        (F.month(d) == month)
        & (F.weekday(d) == weekday)
        & dom.between(7 * (n - 1) + 1, 7 * n)
    )


def _last_weekday(d: Column, month: int, weekday: int) -> Column:
    return (F.month(d) == month) & (F.weekday(d) == weekday) & (F.dayofmonth(d) >= 25)


def is_holiday(d: Column) -> Column:
    """True when ``d`` (a DATE) is an exchange holiday or one-off closure."""
    y = F.year(d)
    mon, thu = 0, 3
    special = F.array(*[F.lit(s).cast("date") for s in SPECIAL_CLOSURES])
    return (
        # New Year's Day; a Saturday New Year is not moved to Friday.
        _fixed_observed(d, y, 1, 1, saturday_shift=False)
        | ((y >= MLK_DAY_FROM) & _nth_weekday(d, 1, mon, 3))
        | _nth_weekday(d, 2, mon, 3)                      # Washington's Birthday
        | (d == F.date_sub(easter_sunday(y), 2))          # Good Friday
        | _last_weekday(d, 5, mon)                        # Memorial Day
        | ((y >= JUNETEENTH_FROM) & _fixed_observed(d, y, 6, 19))
        | _fixed_observed(d, y, 7, 4)                     # Independence Day
        | _nth_weekday(d, 9, mon, 1)                      # Labor Day
        | _nth_weekday(d, 11, thu, 4)                     # Thanksgiving
        | _fixed_observed(d, y, 12, 25)                   # Christmas
        | F.array_contains(special, d)
    )


def nasdaq_open(d: Column) -> Column:
    """Open flag; fails the job for years the rules do not cover."""
    return F.when(
        F.year(d) < FIRST_SUPPORTED_YEAR,
        F.raise_error(F.lit(f"trading calendar: years before {FIRST_SUPPORTED_YEAR} are not supported")),
    ).otherwise((F.weekday(d) < 5) & ~is_holiday(d))


def calendar_rows(days: DataFrame, day_col: str = "d") -> DataFrame:
    """T1 ``date_key, day_of_week, nasdaq_open`` for a frame of dates."""
    d = F.col(day_col)
    return days.select(
        date_key(d).alias("date_key"),
        day_name(d).alias("day_of_week"),
        nasdaq_open(d).alias("nasdaq_open"),
    )


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day in ``[start, end]`` (inclusive), split over tasks by ``range``."""
    n = (end - start).days + 1
    return spark.range(0, max(n, 0)).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))


def date_spine_between(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Every day between each row's start and end (inclusive), without the driver.

    The spine of one range is generated in one task; it holds one row per
    calendar day, i.e. at most tens of thousands of rows.
    """
    return bounds.select(
        F.explode(F.sequence(F.to_date(F.col(start_col)), F.to_date(F.col(end_col)))).alias("d")
    )


def trading_calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """T1 for ``[start, end]`` inclusive."""
    if start.year < FIRST_SUPPORTED_YEAR:
        raise ValueError(f"trading calendar: years before {FIRST_SUPPORTED_YEAR} are not supported")
    return calendar_rows(date_spine(spark, start, end))
