"""Fiscal calendar: a fiscal year is named by the calendar year it ends in; a year end that a year lacks (29 Feb) is the 28th."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_end(year: Column, month: int, day: int) -> Column:
    text = F.format_string(f"%04d-{month:02d}-{day:02d}", year)
    return F.coalesce(F.try_to_date(text), F.make_date(year, F.lit(month), F.lit(28)))


def year_start(year: Column, month: int, day: int) -> Column:
    return F.date_add(year_end(year - 1, month, day), 1)


def containing(day_of: Column, month: int, day: int) -> Column:
    y = F.year(day_of)
    return F.when(day_of <= year_end(y, month, day), y).otherwise(y + 1)


def completed(day_of: Column, month: int, day: int) -> Column:
    """The last fiscal year that had ended by a date."""
    return containing(day_of, month, day) - 1


def from_period(day_of: Column, month: int, day: int, tolerance: int = 10) -> Column:
    """The fiscal year whose end lies within the tolerance (this year, the one before, the one after), else null."""
    y = F.year(day_of)
    near = [F.when(F.abs(F.datediff(day_of, year_end(c, month, day))) <= tolerance, c) for c in (y, y - 1, y + 1)]
    return F.coalesce(*near)
