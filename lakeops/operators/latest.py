"""One row per key, chosen by a total order.

``row_number() = 1`` is written directly over the keys so that the optimizer keeps
only the best row per key inside every input task before the shuffle: a key that
owns a third of all rows then costs one row per task, not one huge task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _tie_break(df: DataFrame, used: list[str], tie_break: list[str] | None) -> list[str]:
    return [c for c in df.columns if c not in used] if tie_break is None else tie_break


def _first_in_order(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def latest_by(df: DataFrame, keys: list[str], order: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` values per key.

    Ties are settled by ``tie_break``, by default all remaining columns, so the result
    does not depend on how rows are spread over tasks. NULL keys form one group.
    """
    columns = [*order, *_tie_break(df, [*keys, *order], tie_break)]
    return _first_in_order(df, keys, [F.col(c).desc_nulls_last() for c in columns])


def first_by(df: DataFrame, keys: list[str], order: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """The row with the smallest ``order`` values per key."""
    columns = [*order, *_tie_break(df, [*keys, *order], tie_break)]
    return _first_in_order(df, keys, [F.col(c).asc_nulls_last() for c in columns])
