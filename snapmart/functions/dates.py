"""The monthly snapshot spine."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_starts(start: date, end: date) -> list[date]:
    """First of each month from the month of `start` up to and including `end`."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [date(month // 12, month % 12 + 1, 1) for month in range(first, last + 1)]


def month_sequence(start: Column, end: Column) -> Column:
    """The same spine as an array column, for dates found in the data."""
    return F.sequence(F.trunc(start, "month"), end, F.expr("interval 1 month"))
