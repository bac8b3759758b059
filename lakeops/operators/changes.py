"""Change detection against the current state."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.schema import TRACKED_PRICES


def detect_changes(
    new: DataFrame,
    current: DataFrame,
    key: str = "id",
    tracked: list[str] = TRACKED_PRICES,
    null_safe: bool = False,
    small_batch: bool = False,
) -> DataFrame:
    """Rows of ``new`` whose key is unknown or whose tracked columns differ.

    A comparison with NULL finds no difference unless ``null_safe``. ``small_batch``
    first reduces the state to the keys of the batch, so that a small batch is sent to
    the state (when its measured size allows) and the state itself is not shuffled.
    """
    lookup = current.select(key, *tracked)
    if small_batch:
        lookup = lookup.join(new.select(key), key, "left_semi")
    lookup = lookup.select(key, F.struct(*tracked).alias("_before"))
    before = F.col("_before")
    if null_safe:
        differs = [~F.col(c).eqNullSafe(before[c]) for c in tracked]
    else:
        differs = [F.col(c) != before[c] for c in tracked]
    return (
        new.join(lookup, key, "left")
        .filter(before.isNull() | reduce(or_, differs))
        .select(new.columns)
    )


def drop_stale(batch: DataFrame, current: DataFrame, order: str, key: str = "id") -> DataFrame:
    """Rows of ``batch`` that are not older than the state row of the same key.

    A row without an order value cannot be told to be older, and stays.
    """
    seen = current.select(key, F.col(order).alias("_seen"))
    return (
        batch.join(seen, key, "left")
        .filter(F.col("_seen").isNull() | F.col(order).isNull() | (F.col(order) >= F.col("_seen")))
        .select(batch.columns)
    )
