"""Rows of vectors as the two nearest-neighbour joins take them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.session import staged


def finite(vector: Column) -> Column:
    """Whether a vector has components, none of them NULL, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` (vec_id, v) of the most frequent length (the shorter one of equals), written once.

    ``n`` numbers them without regard to any value, so that blocks by ``n`` are even even if
    one id or one vector has most rows. A NULL id cannot be named in a result and is left out.
    """
    rows = rows.filter(F.col("vec_id").isNotNull()).withColumn("n", F.monotonically_increasing_id())
    rows = staged(rows, label)
    lengths = rows.groupBy(F.size("v").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").select("length").limit(1)
    return rows.join(F.broadcast(usual), F.size("v") == F.col("length"), "left_semi")


def asked(rows: DataFrame, every: int) -> DataFrame:
    """The queries: rows whose id is divisible; of a repeated id, the row with the smallest vector."""
    return rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def ranked(found: DataFrame, k: int, *best_first: Column) -> DataFrame:
    """The ``k`` best rows of every query over all blocks, with their rank."""
    order = W.partitionBy("query_id").orderBy(*best_first, "vec_id")
    out = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
