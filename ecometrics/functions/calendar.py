"""Dates as text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ecometrics.functions.text import as_column

DAY_FORMAT = "yyyy-MM-dd"


def day_text(value: Column | str) -> Column:
    return F.date_format(as_column(value), DAY_FORMAT)


def parsed_day(value: Column | str) -> Column:
    """NULL for text that is no date."""
    return F.try_to_date(as_column(value), DAY_FORMAT)
