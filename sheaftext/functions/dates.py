"""Business dates: file-name dates and retention cut-offs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def business_date(ddmmyy: Column, century: int = 20) -> Column:
    """``ddmmyy`` with the given century as a date; null when it is not a date."""
    full = F.concat(F.substring(ddmmyy, 1, 4), F.lit(f"{century:02d}"), F.substring(ddmmyy, 5, 2))
    return F.when(F.length(ddmmyy) == 6, F.try_to_timestamp(full, F.lit("ddMMyyyy")).cast("date"))


def business_date_text(ddmmyy: Column, century: int = 20) -> Column:
    return F.date_format(business_date(ddmmyy, century), "yyyy-MM-dd")


def file_date(day: Column) -> Column:
    """The ``ddmmyy`` spelling of a date."""
    return F.date_format(day, "ddMMyy")


def retention_cutoff(today: Column, days: int | Column) -> Column:
    """The first day that is kept: ``today`` minus the retention in days."""
    return F.date_sub(today.cast("date"), days)


def is_expired(day: Column, today: Column, days: int | Column) -> Column:
    """A value that is no date, such as that of a default partition, never expires."""
    return F.coalesce(day.try_cast("date") < retention_cutoff(today, days), F.lit(False))
