"""Stamping, cleaning, type coercion and row-level selection."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.dates import date_in_name, day, safe_date
from lakeops.functions.pricing import discount_percent, discounted
from lakeops.functions.text import HOT_FROM_UNITS, sales_status

# Numeric columns whose NULL means zero, and text columns that are trimmed.
ZERO_IF_NULL = ["price", "discount_rate", "quantity_sold"]
TRIMMED = ["name", "brand_name"]


def stamp_batch(
    df: DataFrame,
    source_file: str | Column | None = None,
    loaded_at: datetime | None = None,
    own_date: str | None = None,
) -> DataFrame:
    """Source name, load time, active flag and the date found in the source name.

    Without ``source_file`` the name of the file each row was read from is used.
    ``own_date`` names a column whose date, when valid, wins over the file's.
    """
    name = F.col("_metadata.file_name") if source_file is None else source_file
    name = F.lit(name) if isinstance(name, str) else name
    stamped = df.withColumns(
        {
            "source_file": name,
            "loaded_at": F.current_timestamp() if loaded_at is None else F.lit(loaded_at),
            "is_active": F.lit(True),
        }
    )
    crawl_date = date_in_name(F.col("source_file"))
    if own_date:
        crawl_date = F.coalesce(safe_date(F.col(own_date).cast("string")), crawl_date)
    return stamped.withColumn("crawl_date", crawl_date)


def stamp_events(
    df: DataFrame,
    source_file: str = "stream",
    loaded_at: datetime | None = None,
    default_active: bool | None = None,
) -> DataFrame:
    """Constant source, one load time and a typed date for a micro-batch.

    ``default_active`` fills the flag of events that carry none.
    """
    stamped = df.withColumns(
        {
            "source_file": F.lit(source_file),
            "loaded_at": F.current_timestamp() if loaded_at is None else F.lit(loaded_at),
            "crawl_date": safe_date(F.col("crawl_date")),
        }
    )
    if default_active is None:
        return stamped
    return stamped.withColumn("is_active", F.coalesce("is_active", F.lit(default_active)))


def clean_records(
    df: DataFrame, key: str = "id", zero_if_null: list[str] = ZERO_IF_NULL, trimmed: list[str] = TRIMMED
) -> DataFrame:
    """Rows with a key, NULL numbers as zero, text without leading and trailing spaces."""
    changes: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(0)) for c in zero_if_null}
    changes |= {c: F.trim(F.col(c)) for c in trimmed}
    return df.filter(F.col(key).isNotNull()).withColumns(changes)


def fill_and_label(
    df: DataFrame,
    numeric: list[str],
    price: str = "price",
    units: str = "quantity_sold",
    hot_from: int = HOT_FROM_UNITS,
) -> DataFrame:
    """NULL numbers as zero, priced rows only, and a sales class by units sold."""
    return (
        df.fillna(0, subset=numeric)
        .filter(F.col(price) > 0)
        .withColumn("sales_status", sales_status(F.col(units), hot_from))
    )


def coerce_types(df: DataFrame, types: Mapping[str, str], error: str = "error") -> DataFrame:
    """Columns cast to the given types; ``error`` lists those with a value that did not fit."""
    failed = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items()
    ]
    return df.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns],
        F.nullif(F.concat_ws(",", *failed), F.lit("")).alias(error),
    )


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good rows without the error column, and the rows to quarantine."""
    good = df.filter(F.col(error).isNull()).drop(error)
    return good, df.filter(F.col(error).isNotNull())


def reprice(
    df: DataFrame,
    cut: float | Column,
    price: str = "price",
    original: str = "original_price",
    discount: str = "discount",
    rate: str = "discount_rate",
) -> DataFrame:
    """Price, discount and discount percent after a price cut; unpriced rows stay as they are."""
    priced = F.col(price) > 0
    base = F.coalesce(F.col(original), F.col(price))
    new_price = discounted(F.col(price), cut)
    off = base - new_price
    return df.withColumns(
        {
            price: F.when(priced, new_price).otherwise(F.col(price)),
            discount: F.when(priced, off).otherwise(F.col(discount)),
            rate: F.when(priced, discount_percent(off, base)).otherwise(F.col(rate)),
        }
    )


def partition_day(df: DataFrame, value: str | date, column: str = "crawl_date") -> DataFrame:
    """Rows of one day; the typed comparison reaches the partition filter."""
    return df.filter(F.col(column) == day(value))


def date_range(
    df: DataFrame, from_date: str | date | None = None, to_date: str | date | None = None, column: str = "crawl_date"
) -> DataFrame:
    """Rows between two days, both included; None leaves an end open."""
    if from_date is None and to_date is None:
        return df
    return df.filter(in_range(from_date, to_date, column))


def in_range(from_date: str | date | None, to_date: str | date | None, column: str = "crawl_date") -> Column:
    """Whether a day lies between two days, both included; None leaves an end open."""
    after = F.lit(True) if from_date is None else F.col(column) >= day(from_date)
    return after if to_date is None else after & (F.col(column) <= day(to_date))


def list_dates(df: DataFrame, column: str = "crawl_date") -> DataFrame:
    """The distinct days as text, in order."""
    return df.select(column).distinct().orderBy(column).select(F.col(column).cast("string").alias("d"))
