"""Date expressions that give NULL, not an error, on bad input."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a date is written in names of files and in arguments.
ISO_DATE = r"\d{4}-\d{2}-\d{2}"


def safe_date(text: Column) -> Column:
    """Text as a date; NULL when it is not one."""
    return F.try_to_date(text)


def date_in_name(name: Column) -> Column:
    """The first ISO date inside a file name; NULL when there is none."""
    return safe_date(F.regexp_extract(name, f"({ISO_DATE})", 1))


def last_date_in_path(path: Column) -> Column:
    """The last ISO date in a path, so a file's date wins over its folder's."""
    return safe_date(F.regexp_extract(path, f".*({ISO_DATE})", 1))


def day(value: str | date) -> Column:
    """A date literal, so that comparisons stay typed and reach the partition filter."""
    return F.lit(value if isinstance(value, date) else date.fromisoformat(value))
