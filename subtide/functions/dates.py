"""Date helpers. Every "today" is an explicit ``as_of`` date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_or_today(as_of: dt.date | None) -> dt.date:
    return as_of if as_of is not None else dt.date.today()


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "month")


def month_label(month: Column | str) -> Column:
    return F.date_format(month, "yyyy-MM")


def next_month(day: Column) -> Column:
    """First day of the month after ``day``'s."""
    return F.add_months(month_start(day), 1)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(end, start).cast("long")
