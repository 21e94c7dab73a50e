"""Trading-calendar expressions. ``weekday`` counts Monday as 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_trading_day(date: Column) -> Column:
    """True from Monday to Friday. Exchange holidays are not known here."""
    return F.weekday(date) < 5


def previous_trading_day(date: Column) -> Column:
    """The calendar day before, except that Monday goes back to Friday."""
    return F.date_sub(date, F.when(F.weekday(date) == 0, 3).otherwise(1))
