"""Calendar periods: year, month, and seasons that begin in December."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names in configurations and their codes.
CODES = {"annual": "YS", "monthly": "MS", "seasonal": "QS-DEC"}


def period_code(name: str | None) -> str:
    """The code of a configured period; the year for any other name."""
    return CODES.get(name or "", "YS")


def period_start(day: Column, code: str) -> Column:
    """The first day of the period that holds day."""
    if code == "YS":
        return F.trunc(day, "year")
    if code == "MS":
        return F.trunc(day, "month")
    if code == "QS-DEC":
        return F.add_months(F.trunc(F.add_months(F.trunc(day, "month"), 1), "quarter"), -1)
    raise ValueError(f"unknown period code {code!r}")


def period_months(code: str) -> int:
    return {"YS": 12, "MS": 1, "QS-DEC": 3}[code]


def leap_day(start: Column, months: int) -> Column:
    """29 February within the months from start on, else null."""
    year = F.year(F.add_months(start, months - 1))
    last = F.date_sub(F.make_date(year, F.lit(3), F.lit(1)), 1)
    return F.when((F.dayofmonth(last) == 29) & (last >= start) & (last < F.add_months(start, months)), last)


def day_in_period(day: Column, start: Column, calendar: Column) -> Column:
    """Days since start; a calendar without leap days steps over 29 February."""
    leap = leap_day(start, 12)
    return F.datediff(day, start) - F.when((calendar == "noleap") & (day > leap), 1).otherwise(0)


def day_number(day: Column, calendar: Column) -> Column:
    """A number that grows by one from each day of a calendar to the next, over years; of a 360-day calendar the days after
    28 February may share a date, and then a number."""
    year, leap = F.year(day), F.make_date(F.year(day), F.lit(3), F.lit(1))
    before = F.dayofyear(day) - F.when((F.dayofyear(leap) == 61) & (day >= leap), 1).otherwise(0)
    return (
        F.when(calendar == "360_day", (year * 12 + F.month(day) - 1) * 30 + F.least(F.dayofmonth(day), F.lit(30)))
        .when(calendar == "noleap", year * 365 + before)
        .otherwise(F.datediff(day, F.lit("1970-01-01").cast("date")))
    )


def expected_days(start: Column, code: str, calendar: Column) -> Column:
    """Days of the period that begins at start, by calendar: standard, noleap, or 360_day."""
    months = period_months(code)
    days = F.datediff(F.add_months(start, months), start)
    holds = leap_day(start, months).isNotNull()
    return (
        F.when(calendar == "360_day", F.lit(30 * months))
        .when(calendar == "noleap", days - holds.cast("int"))
        .otherwise(days)
    )


def year_span(start: Column, end: Column) -> Column:
    """Years from start to end, both included."""
    return end - start + 1


def year_bounds(year: Column) -> tuple[Column, Column]:
    """Noon of the first and of the last day of a year."""
    at = lambda month, day: F.make_timestamp_ntz(year, F.lit(month), F.lit(day), F.lit(12), F.lit(0), F.lit(0))
    return at(1, 1), at(12, 31)
