"""Text clean-up and labelling expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the sales classes and the price moves.
HOT, SLOW = "Hot", "Slow"
HOT_FROM_UNITS = 500
FIRST_SEEN = "Lần đầu ghi nhận"
PRICE_UP = "Tăng giá"
PRICE_DOWN = "Giảm giá"
PRICE_SAME = "Không đổi"

# Fixed value: the brand of a product that names none.
NO_BRAND = "No Brand"


def clean_name(name: Column, comma: str = " -", newline: str | None = " ", drop: str = "\r'\"") -> Column:
    """A name with commas and line feeds replaced and the characters in ``drop`` removed."""
    single = ("\n" if newline is not None else "") + drop
    if single:
        name = F.translate(name, single, newline or "")
    return F.replace(name, F.lit(","), F.lit(comma))


def sales_status(units: Column, hot_from: int = HOT_FROM_UNITS) -> Column:
    return F.when(units >= hot_from, HOT).otherwise(SLOW)


def price_move(price: Column, previous: Column) -> Column:
    """How a price compares with the one before it."""
    return (
        F.when(previous.isNull(), FIRST_SEEN)
        .when(price > previous, PRICE_UP)
        .when(price < previous, PRICE_DOWN)
        .otherwise(PRICE_SAME)
    )


def label_if_empty(text: Column, label: str) -> Column:
    return F.when(text == "", label).otherwise(text)
