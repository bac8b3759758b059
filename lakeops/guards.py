"""Checks that stop a job early with a clear message."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import ISO_DATE


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """``df`` itself, or ValueError when it holds no row; reads one row at most."""
    if df.limit(1).isEmpty():
        raise ValueError(f"{what} holds no rows")
    return df


def require_table(spark: SparkSession, name: str) -> DataFrame:
    """The named table, or ValueError when the catalogue does not list it."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    return spark.table(name)


def require_date(text: str) -> date:
    """The ISO date inside a file name or an argument, or ValueError."""
    found = re.search(ISO_DATE, text)
    if found is None:
        raise ValueError(f"no date of the form YYYY-MM-DD in {text!r}")
    return date.fromisoformat(found.group())


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself, or ValueError when a key occurs twice."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"several rows for key {repeated[0].asDict()}")
    return df
