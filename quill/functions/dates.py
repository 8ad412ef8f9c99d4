"""Date helpers. The run date is always an explicit ``as_of`` parameter.

Calendar filters are emitted as half-open literal ranges so Catalyst pushes
them into the Parquet scan (``year(c) = k`` would only push ``IsNotNull``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quill.functions._col import as_col
from quill.functions.numeric import trunc0

AS_OF = dt.date(2001, 8, 15)


def year_bounds(year: int) -> tuple[dt.datetime, dt.datetime]:
    return dt.datetime(year, 1, 1), dt.datetime(year + 1, 1, 1)


def month_bounds(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    nxt = (year + 1, 1) if month == 12 else (year, month + 1)
    return dt.datetime(year, month, 1), dt.datetime(*nxt, 1)


def ts_lit(t: dt.datetime) -> Column:
    """Wall-clock timestamp literal (TIMESTAMP_NTZ): no session or process
    time zone can move a calendar boundary. Folded to a constant, so still
    pushed into the scan."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def in_range(c, bounds) -> Column:
    lo, hi = bounds
    c = as_col(c)
    return (c >= ts_lit(lo)) & (c < ts_lit(hi))


def in_year(c, year: int) -> Column:
    """``EXTRACT(YEAR FROM c) = year`` as a pushable range."""
    return in_range(c, year_bounds(year))


def in_month(c, year: int, month: int) -> Column:
    """``EXTRACT(MONTH FROM c) = month AND EXTRACT(YEAR FROM c) = year``."""
    return in_range(c, month_bounds(year, month))


def add_months_year(as_of: dt.date, months: int) -> int:
    """Year of ``ADD_MONTHS(as_of, months)`` (only the year is ever used)."""
    m = as_of.year * 12 + (as_of.month - 1) + months
    return m // 12


def to_day(c) -> Column:
    """Calendar day of a timestamp (NTZ: independent of the session zone)."""
    return F.to_date(as_col(c))


def years_between(as_of, d) -> Column:
    """``TRUNC(MONTHS_BETWEEN(as_of, d) / 12)`` — whole years of service."""
    a = F.lit(as_of) if isinstance(as_of, dt.date) else as_col(as_of)
    return trunc0(F.months_between(a, to_day(d), False) / 12).cast("int")


_DAY_SECONDS = 86_400


def days_between(later, earlier) -> Column:
    """``later - earlier`` in days, fractions of a day included: exact to the
    second, as DECIMAL(20,10) (whole days plus seconds of a day over 86,400)."""
    later, earlier = as_col(later), as_col(earlier)
    whole = F.datediff(to_day(later), to_day(earlier)).cast("decimal(10,0)")

    def seconds(c: Column) -> Column:
        return (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("decimal(10,0)")

    part = (seconds(later) - seconds(earlier)) / F.lit(_DAY_SECONDS).cast("decimal(10,0)")
    return (whole + part.cast("decimal(12,10)")).cast("decimal(20,10)")
