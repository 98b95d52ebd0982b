"""Date, year and month of a column that holds epoch seconds, a date or a timestamp.

Epoch seconds are read as UTC whatever the session time zone is: the day number
is the floor of seconds by 86400, and date and year follow from that.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

# Seconds per day, and the epoch seconds of years 1 to 9999.
DAY_SECONDS = 86_400
FIRST_EPOCH = -62_135_596_800
LAST_EPOCH = 253_402_300_799


def epoch_to_date(seconds: Column) -> Column:
    """UTC date of epoch seconds; NULL for NULL and outside years 1 to 9999."""
    day = F.floor(seconds / DAY_SECONDS).cast("int")
    return F.when(seconds.between(FIRST_EPOCH, LAST_EPOCH), F.date_from_unix_date(day))


def day_of(df: DataFrame, when: str) -> Column:
    """Date of the time column ``when`` of ``df``, chosen by the column's type."""
    if isinstance(df.schema[when].dataType, IntegralType):
        return epoch_to_date(F.col(when))
    return F.to_date(F.col(when))


def year_of(df: DataFrame, when: str) -> Column:
    return F.year(day_of(df, when))


def month_of(df: DataFrame, when: str) -> Column:
    return F.month(day_of(df, when))


def day_number(df: DataFrame, when: str) -> Column:
    """Days since 1970-01-01 of the time column ``when``."""
    return F.unix_date(day_of(df, when))


def add_period(df: DataFrame, when: str, year: str, month: str) -> DataFrame:
    """Add year and month columns derived from ``when``."""
    return df.withColumns({year: year_of(df, when), month: month_of(df, when)})


def _bounds(df: DataFrame, when: str, year: int) -> tuple[Column, Column]:
    kind = df.schema[when].dataType
    if isinstance(kind, IntegralType):
        start, end = (
            F.unix_date(F.lit(f"{y:04d}-01-01").cast("date")).cast("bigint") * DAY_SECONDS
            for y in (year, year + 1)
        )
        return start, end
    if not isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        raise TypeError(f"{when} is {kind.simpleString()}, not a time column")
    start, end = (F.lit(f"{y:04d}-01-01").cast(kind) for y in (year, year + 1))
    return start, end


def within_years(df: DataFrame, when: str, years: Iterable[int]) -> DataFrame:
    """Rows whose ``when`` falls into one of ``years``.

    A test on year(when) reaches no Parquet reader. A range of the stored
    column per year does, and skips row groups.
    """
    ranges = []
    for year in sorted(set(years)):
        start, end = _bounds(df, when, year)
        ranges.append((F.col(when) >= start) & (F.col(when) < end))
    return df.filter(reduce(or_, ranges, F.lit(False)))
