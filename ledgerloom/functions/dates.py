"""Date, week and clock expressions. Timestamps are naive UTC; the site's zone is a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def instant(value: dt.datetime) -> Column:
    """A naive UTC timestamp literal, independent of the session zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_day(c: Column) -> Column:
    """Date of an ISO text, with or without a time; null when the whole text is none."""
    text = F.trim(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d.*)?$"), text.try_cast("timestamp_ntz")).cast("date")


def week_start(value: dt.date) -> dt.date:
    """Monday of the week of a date."""
    return value - dt.timedelta(days=value.weekday())


def week_index(c: Column, first_monday: dt.date) -> Column:
    """Whole weeks since a Monday, rounded down (earlier dates are negative)."""
    return F.floor(F.datediff(c, day(first_monday)) / 7).cast("int")


def week_label(start: Column) -> Column:
    end = F.date_add(start, 6)
    return F.concat(F.lit("Semana "), F.date_format(start, "dd/MM"), F.lit(" - "), F.date_format(end, "dd/MM"))


def local_time(ts: Column, tz: str) -> Column:
    """Site-local wall time of a naive UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts.cast("timestamp_ntz"))


def local_date(ts: Column, tz: str) -> Column:
    return F.to_date(local_time(ts, tz))


def clock(ts: Column, tz: str, pattern: str = "HH:mm:ss") -> Column:
    return F.date_format(local_time(ts, tz), pattern)


def within_local_days(ts: Column, tz: str, first: dt.date, last: dt.date) -> Column:
    """Local date in [first, last]. The plain UTC range beside it reaches the scan."""
    low = dt.datetime.combine(first - dt.timedelta(days=1), dt.time())
    high = dt.datetime.combine(last + dt.timedelta(days=2), dt.time())
    return (
        (ts >= instant(low)) & (ts < instant(high))
        & local_date(ts, tz).between(day(first), day(last))
    )


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from one naive timestamp to another, independent of the session zone."""
    span = end - start
    seconds = (
        F.extract(F.lit("DAY"), span).cast("bigint") * 86_400
        + F.extract(F.lit("HOUR"), span) * 3_600
        + F.extract(F.lit("MINUTE"), span) * 60
    )
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), span) * 1_000_000).cast("bigint")


def hours(micros: Column, decimals: int = 2) -> Column:
    """Hours of a microsecond span, rounded half up on the exact value."""
    unit = 3_600_000_000 // 10**decimals
    padded = micros + unit // 2
    return (padded - F.pmod(padded, F.lit(unit))) / unit / F.lit(float(10**decimals))


def days_overdue(due: Column, as_of: dt.date) -> Column:
    return F.when(due < day(as_of), F.datediff(day(as_of), due)).otherwise(0)


def days_until(due: Column, as_of: dt.date) -> Column:
    """Days left to a date; today is 0."""
    return F.datediff(due, day(as_of))


def days_until_floor(due: Column, now: dt.datetime) -> Column:
    """Days left counted from an instant and rounded down: a date equal to today gives -1."""
    micros = micros_between(instant(now), due.cast("timestamp_ntz"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")


def inclusive_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def display_date(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def iso_prefix(c: Column) -> Column:
    """First ten characters of an ISO text."""
    return F.substring(c, 1, 10)
