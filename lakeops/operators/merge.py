"""Row-level upserts and deletes as joins.

State and batch hold one row per key, so no key can be hot. An upsert is a join from the
state's side plus a union: with a batch below the broadcast threshold the state is neither
shuffled nor sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.guards import require_unique
from lakeops.operators.latest import latest_by


def upsert(
    state: DataFrame,
    batch: DataFrame,
    key: str = "id",
    snapshot_scope: str | None = None,
    active: str = "is_active",
    on_duplicate: str = "latest",
    order: list[str] | None = None,
) -> DataFrame:
    """``state`` with the rows of ``batch`` overwriting or joining those of the same key.

    Of batch rows that share a key the latest by ``order`` counts (then by all columns);
    with ``on_duplicate="error"`` they raise an error, and with ``"unique"`` the caller
    vouches that there are none. Rows without a key match nothing, and are all kept.
    ``snapshot_scope`` names the column that says what a full snapshot covers: state
    rows missing from the batch become inactive when the batch has rows in their scope.
    """
    batch = one_per_key(batch, key, on_duplicate, order)
    untouched = state.join(batch.select(key), key, "left_anti").select(state.columns)
    if snapshot_scope:
        untouched = deactivate(untouched, batch.select(snapshot_scope), snapshot_scope, active)
    return untouched.unionByName(batch.select(state.columns))


def one_per_key(batch: DataFrame, key: str, on_duplicate: str, order: list[str] | None) -> DataFrame:
    """``batch`` with one row per key that is not NULL."""
    if on_duplicate == "unique":
        return batch
    keyed, without = batch.filter(F.col(key).isNotNull()), batch.filter(F.col(key).isNull())
    if on_duplicate == "error":
        require_unique(keyed, [key])
        return batch
    if on_duplicate != "latest":
        raise ValueError(f"unknown choice {on_duplicate!r}")
    return latest_by(keyed, [key], order or []).unionByName(without)


def deactivate(rows: DataFrame, covered: DataFrame, scope: str, active: str = "is_active") -> DataFrame:
    """``rows`` with the active flag cleared where their scope value is in ``covered``."""
    marker = covered.filter(F.col(scope).isNotNull()).distinct().withColumn("_covered", F.lit(True))
    flag = F.when(F.col("_covered"), F.lit(False)).otherwise(F.col(active))
    return rows.join(marker, scope, "left").withColumn(active, flag).select(rows.columns)


def upsert_columns(state: DataFrame, batch: DataFrame, update: list[str], key: str = "id") -> DataFrame:
    """Matched rows take only the ``update`` columns of the batch; new keys are inserted whole."""
    new = batch.select(key, F.struct(*update).alias("_new"))
    matched = F.col("_new").isNotNull()
    kept = state.join(new, key, "left").select(
        *(F.when(matched, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in state.columns)
    )
    added = batch.join(state.select(key), key, "left_anti").select(state.columns)
    return kept.unionByName(added)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is false or unknown."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))
