"""Month arithmetic from a fixed reporting date, and local time labels."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def months_before(reporting_date: str | dt.date, months: int) -> Column:
    return F.add_months(as_date(reporting_date), -months)


def date_key(col: Column) -> Column:
    """A date as the integer ``yyyymmdd``."""
    return F.date_format(col, "yyyyMMdd").cast("int")


def cutoff_key(reporting_date: str | dt.date, months: int = 12) -> Column:
    """The date key ``months`` before the reporting date; folds to one literal."""
    return date_key(months_before(reporting_date, months))


def is_overdue(col: Column, reporting_date: str | dt.date) -> Column:
    return col < as_date(reporting_date)


def local_label(col: Column, zone: str, pattern: str = "dd MMM yyyy HH:mm") -> Column:
    """A UTC run time as text in the reader's time zone."""
    return F.coalesce(
        F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), col), pattern),
        F.lit("unknown time"),
    )
