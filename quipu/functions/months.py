"""Month keys (yyyy-MM text) and month lists."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(as_of) -> Column:
    """A date column from a column, a date, ISO text, or None for today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


def month_key(date) -> Column:
    return F.date_format(as_date(date), "yyyy-MM")


def month_sql(as_of) -> str:
    """SQL for the month key of a date, of ISO text, or of today (None)."""
    if as_of is None:
        return "date_format(current_date(), 'yyyy-MM')"
    day = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    return f"'{day:%Y-%m}'"


def month_start(corte: Column) -> Column:
    """First day of a yyyy-MM key; null when the text is not a month."""
    return F.when(corte.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), F.try_to_date(F.concat(corte, F.lit("-01"))))


def months_from(first: Column, n: int) -> Column:
    """Array of n month keys; first is any date in the first month."""
    start = F.trunc(first, "MM")
    days = F.sequence(start, F.add_months(start, n - 1), F.expr("interval 1 month"))
    return F.transform(days, lambda d: F.date_format(d, "yyyy-MM"))


def close_months(as_of) -> tuple:
    """(closing month, opening month) of a run date."""
    day = as_date(as_of)
    return month_key(F.add_months(F.trunc(day, "MM"), -1)), month_key(day)
