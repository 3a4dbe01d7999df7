from datetime import date, timedelta

import pytest
from dateutil.easter import easter

from daybook.operators import trading_calendar


def _rows(spark, start, end):
    return {r.date_key: r for r in trading_calendar(spark, start, end).collect()}


def test_january_2024_weekends_and_holidays(spark):
    rows = _rows(spark, date(2024, 1, 1), date(2024, 1, 31))
    for closed in (20240101, 20240106, 20240107, 20240115):
        assert rows[closed].nasdaq_open is False
    assert rows[20240102].nasdaq_open is True


def test_first_week_of_2024(spark):
    out = sorted(trading_calendar(spark, date(2024, 1, 1), date(2024, 1, 7)).collect())
    assert [tuple(r) for r in out][:2] == [(20240101, "monday", False), (20240102, "tuesday", True)]
    assert [r.day_of_week for r in out] == [
        "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def test_2024_holidays_and_open_days(spark):
    rows = _rows(spark, date(2024, 1, 1), date(2024, 12, 31))
    assert len(rows) == 366
    weekday_closed = sorted(k for k, r in rows.items()
                            if not r.nasdaq_open and r.day_of_week not in ("saturday", "sunday"))
    assert weekday_closed == [20240101, 20240115, 20240219, 20240329, 20240527,
                              20240619, 20240704, 20240902, 20241128, 20241225]
    assert sum(r.nasdaq_open for r in rows.values()) == 252
    assert rows[20241231].nasdaq_open is True
    assert rows[20241231].day_of_week == "tuesday"


@pytest.mark.parametrize("year,open_days", [
    (2001, 248), (2012, 250), (2018, 251), (2020, 253), (2022, 251), (2023, 250), (2025, 250)])
def test_year_totals(spark, year, open_days):
    rows = _rows(spark, date(year, 1, 1), date(year, 12, 31))
    assert sum(r.nasdaq_open for r in rows.values()) == open_days


def _python_open(d: date) -> bool:
    """Plain-Python restatement of the exchange rules, for comparison."""
    if d.weekday() >= 5:
        return False
    y = d.year

    def observed(h, sat_shift=True):
        if h.weekday() == 5:
            return h - timedelta(days=1) if sat_shift else None
        if h.weekday() == 6:
            return h + timedelta(days=1)
        return h

    def nth(month, weekday, n):
        first = date(y, month, 1)
        return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))

    def last(month, weekday):
        end = date(y, month + 1, 1) - timedelta(days=1)
        return end - timedelta(days=(end.weekday() - weekday) % 7)

    hol = {observed(date(y, 1, 1), False), nth(2, 0, 3), easter(y) - timedelta(days=2),
           last(5, 0), observed(date(y, 7, 4)), nth(9, 0, 1), nth(11, 3, 4),
           observed(date(y, 12, 25))}
    if y >= 1998:
        hol.add(nth(1, 0, 3))
    if y >= 2022:
        hol.add(observed(date(y, 6, 19)))
    special = {date(2001, 9, 11), date(2001, 9, 12), date(2001, 9, 13), date(2001, 9, 14),
               date(2004, 6, 11), date(2007, 1, 2), date(2012, 10, 29), date(2012, 10, 30),
               date(2018, 12, 5), date(2025, 1, 9)}
    return d not in hol and d not in special


def test_matches_python_rules_1995_2035(spark):
    start, end = date(1995, 1, 1), date(2035, 12, 31)
    got = {r.date_key: r.nasdaq_open for r in trading_calendar(spark, start, end).collect()}
    d = start
    mismatches = []
    while d <= end:
        k = d.year * 10000 + d.month * 100 + d.day
        if got[k] != _python_open(d):
            mismatches.append(k)
        d += timedelta(days=1)
    assert mismatches == []
    assert len(got) == (end - start).days + 1


def test_schema(spark):
    df = trading_calendar(spark, date(2024, 1, 1), date(2024, 1, 2))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("date_key", "int"), ("day_of_week", "string"), ("nasdaq_open", "boolean")]


def test_years_before_1995_are_refused(spark):
    with pytest.raises(ValueError):
        trading_calendar(spark, date(1994, 12, 1), date(1995, 1, 31))
