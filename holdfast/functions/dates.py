"""Date column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c: Column | str) -> Column:
    """Lenient date read: unparsable text becomes null."""
    return _col(c).try_cast("date")


def calendar_months(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar months between two dates with the day of month ignored, never negative."""
    a, b = _col(later), _col(earlier)
    months = (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
    return F.when(months.isNotNull(), F.greatest(F.lit(0), months))


def years_as_decimal(later: Column | str, earlier: Column | str) -> Column:
    from holdfast.functions.numeric import even_round

    return even_round(F.datediff(_col(later), _col(earlier)) / F.lit(365.25), 2)


def date_key(c: Column | str) -> Column:
    """Integer yyyymmdd."""
    d = _col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def add_years(c: Column | str, years: Column | int) -> Column:
    """Same day in another year; 29 February falls back to the 28th."""
    return F.add_months(_col(c), (F.lit(years) if isinstance(years, int) else years) * 12)


def week_start(c: Column | str) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", _col(c)).cast("date")
