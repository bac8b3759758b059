"""Price and popularity expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the popularity score.
UNITS_WEIGHT = Decimal("0.5")
REVIEWS_WEIGHT = Decimal("0.3")
DISCOUNT_WEIGHT = Decimal("0.2")
DISCOUNT_SCALE = 10


def in_thousands(amount: Column) -> Column:
    return F.round(amount / F.lit(1000), 1)


def popularity_score(units: Column, rating: Column, reviews: Column, discount_rate: Column) -> Column:
    """Units sold, rating-weighted reviews and discount depth as one number."""
    sold = units * F.lit(UNITS_WEIGHT)
    liked = rating * reviews * F.lit(REVIEWS_WEIGHT)
    cut = discount_rate * F.lit(DISCOUNT_SCALE) * F.lit(DISCOUNT_WEIGHT)
    return F.round(sold + liked + cut, 1)


def discounted(price: Column, cut: float | Column) -> Column:
    """The price after a cut given as a fraction, whole units, rounded towards zero."""
    share = cut if isinstance(cut, Column) else F.lit(float(cut))
    return (price * (F.lit(1.0) - share)).cast("long")


def discount_percent(discount: Column, original: Column) -> Column:
    """Whole percent of the original price, rounded towards zero; 0 without an original price."""
    return F.when(original > 0, (discount / original * 100).cast("int")).otherwise(F.lit(0))
