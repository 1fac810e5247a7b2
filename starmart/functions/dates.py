"""Calendar helpers with the source system's meanings.

* ``year_month``: text ``yyyy-MM`` (the month, not minutes: Spark's ``mm``
  pattern letter means minutes).
* ``iso_day_of_week``: 1 = Monday … 7 = Sunday (Spark's ``dayofweek`` is
  1 = Sunday, so it is not used).
* ``iso_week``: ISO-8601 week number (2017-01-01 is in week 52).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_month(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def iso_day_of_week(c: str | Column) -> Column:
    return (F.weekday(_col(c)) + 1).cast("int")


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(_col(c)).cast("int")


def first_of_month(c: str | Column) -> Column:
    """Date of the first day of the month of a date or timestamp."""
    return F.trunc(F.to_date(_col(c)), "month")


def month_index(c: str | Column) -> Column:
    """year * 12 + month: a running month number."""
    c = _col(c)
    return F.year(c) * 12 + F.month(c)


def months_between_starts(later: str | Column, earlier: str | Column) -> Column:
    """Whole months between two month starts: Δyear·12 + Δmonth (integer)."""
    return (month_index(later) - month_index(earlier)).cast("int")


def elapsed_days(start: str | Column, end: str | Column) -> Column:
    """Fractional days between two zone-less timestamps."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(86_400_000_000.0)


def make_period(year: str | Column, month: str | Column) -> Column:
    """First-of-month date from year and month columns."""
    return F.make_date(_col(year), _col(month), F.lit(1))


def parse_timestamp(c: str | Column) -> Column:
    """Text → zone-less timestamp; malformed text (including '') fails the job.

    The strict cast mirrors a typed target column: bad input is an error,
    not a silent NULL. Use ``try_parse_timestamp`` where NULL is wanted.
    """
    return _col(c).cast("timestamp_ntz")


def try_parse_timestamp(c: str | Column) -> Column:
    """Text → zone-less timestamp, NULL when the text is not a timestamp."""
    return F.try_to_timestamp(_col(c)).cast("timestamp_ntz")
