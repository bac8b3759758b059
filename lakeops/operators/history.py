"""Reading the past: as-of state, change log, replay, version lists."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.latest import latest_by
from lakeops.schema import TRACKED_PRICES


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], chunk: Column | None = None
) -> DataFrame:
    """``df`` with struct column ``previous``: the values of the row before, NULL for the first.

    Without ``chunk`` all rows of a key meet in one task, which is right where a key has a
    bounded number of rows. ``chunk`` is an expression that never falls along ``order`` (a
    month of a date): each chunk of a key looks back inside itself, and its first row takes
    the last values of the chunk before, found from one pre-aggregated row per chunk. Rows
    without a key, or without a chunk, are split and carried like the others.
    """
    row = F.struct(*values)
    if chunk is None:
        return df.withColumn("previous", F.lag(row).over(Window.partitionBy(*keys).orderBy(*order)))
    chunked = df.withColumn("_chunk", chunk)
    tails = chunked.groupBy(*keys, "_chunk").agg(F.max_by(row, F.struct(*order)).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    names = [*keys, "_chunk"]
    carried = tails.select(
        *(F.col(c).alias(f"_of_{c}") for c in names), F.lag("_tail").over(across).alias("_carried")
    )
    inside = Window.partitionBy(*names).orderBy(*order)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in names))
    return (
        chunked.withColumn("_inside", F.lag(row).over(inside))
        .join(carried, same)
        .select(*df.columns, F.coalesce("_inside", "_carried").alias("previous"))
    )


def change_log(
    daily: DataFrame,
    key: str = "id",
    order: str = "crawl_date",
    tracked: list[str] = TRACKED_PRICES,
    null_safe: bool = False,
) -> DataFrame:
    """First sightings and rows whose tracked columns differ from the key's row before.

    Expects one row per (key, order value), so a key has at most one row per day.
    """
    before = F.col("previous")
    if null_safe:
        differs = [~F.col(c).eqNullSafe(before[c]) for c in tracked]
    else:
        differs = [F.col(c) != before[c] for c in tracked]
    return (
        with_previous(daily, [key], [order], tracked)
        .filter(before.isNull() | reduce(or_, differs))
        .select(daily.columns)
    )


def replay_state(
    daily: DataFrame,
    key: str = "id",
    order: str = "crawl_date",
    scope: str = "category_id",
    active: str = "is_active",
    full_snapshot: bool | DataFrame = True,
) -> DataFrame:
    """The state after merging every day of ``daily`` in order, in one pass.

    Expects one row per (key, order value), so the order needs no tie-break.
    A key's state is its last row. With full snapshots it is inactive exactly when a
    later day covers the scope value of that row. Given rows (scope, order) are the full
    snapshots; other rows, such as those of a stream, then cover nothing.
    """
    last = latest_by(daily, [key], [order], tie_break=[])
    if full_snapshot is False:
        return last
    snapshots = daily if full_snapshot is True else full_snapshot
    covered = snapshots.filter(F.col(scope).isNotNull()).groupBy(scope).agg(F.max(order).alias("_covered_until"))
    gone = F.col("_covered_until") > F.col(order)
    return (
        last.join(covered, scope, "left")
        .withColumn(active, F.when(gone, F.lit(False)).otherwise(F.col(active)))
        .select(daily.columns)
    )


def as_of(
    rows: DataFrame, keys: list[str], order: list[str], at: Column, tie_break: list[str] | None = None
) -> DataFrame:
    """The state at a point: the last row per key whose first order column is not after ``at``."""
    return latest_by(rows.filter(F.col(order[0]) <= at), keys, order, tie_break)


def retain_last_n(rows: DataFrame, stamp: str, n: int) -> DataFrame:
    """Rows of the last ``n`` distinct stamps (a top-n and a semi join, no global window)."""
    kept = rows.select(stamp).filter(F.col(stamp).isNotNull()).distinct().orderBy(F.col(stamp).desc()).limit(n)
    return rows.join(kept, stamp, "left_semi").select(rows.columns)


def version_log(
    rows: DataFrame, stamp: str = "crawl_date", source: str = "source_file", loaded: str = "loaded_at"
) -> DataFrame:
    """One line per loaded version: when it was written, from where, how many rows."""
    return rows.groupBy(stamp, source).agg(
        F.min(loaded).alias("first_loaded_at"),
        F.max(loaded).alias("last_loaded_at"),
        F.count(F.lit(1)).alias("row_count"),
    )
