"""Rebuilding log, state and aggregates from the raw table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.guards import require_rows
from lakeops.operators.clean import clean_records, date_range
from lakeops.operators.history import change_log, replay_state
from lakeops.operators.latest import first_by, latest_by
from lakeops.plans.batch import changes_along, write_gold
from lakeops.plans.gold import gold_tables
from lakeops.plans.lake import Lake
from lakeops.sinks.files import append_run, staged_for_a_while


def load_order() -> Column:
    """Days count in order, and inside a day the time of the load."""
    return F.struct("crawl_date", "loaded_at").alias("_order")


def daily_rows(
    raw: DataFrame,
    from_date: str | date | None = None,
    to_date: str | date | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The cleaned last load of each product and day inside the range."""
    days = clean_records(date_range(raw, from_date, to_date))
    return latest_by(days, ["id", "crawl_date"], ["loaded_at"], tie_break)


def rebuild(
    raw: DataFrame,
    from_date: str | date | None = None,
    to_date: str | date | None = None,
    full_snapshot: bool = True,
    tie_break: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(price log, state) as if every day had been loaded in order, in one pass each.

    Where ``raw`` has a column ``ingest``, only rows of the batch writer are full snapshots.
    """
    daily = daily_rows(raw, from_date, to_date, tie_break)
    return replayed(daily, snapshots_of(raw, from_date, to_date) if full_snapshot else False)


def snapshots_of(raw: DataFrame, from_date: str | date | None = None, to_date: str | date | None = None) -> DataFrame:
    """When each scope was covered: (category_id, _order) of the rows the batch writer wrote."""
    rows = date_range(raw, from_date, to_date).filter(F.col("id").isNotNull())
    if "ingest" in raw.columns:
        rows = rows.filter(F.col("ingest") == "batch")
    return rows.select("category_id", load_order()).distinct()


def replayed(daily: DataFrame, full_snapshot: bool | DataFrame = True) -> tuple[DataFrame, DataFrame]:
    """Log and state of daily rows; the last load of a day counts, and days count in order."""
    daily = daily.drop("ingest")
    ordered = daily.withColumn("_order", load_order())
    state = replay_state(ordered, order="_order", full_snapshot=full_snapshot)
    return change_log(daily), state.select(daily.columns)


def plan_recovery(
    raw: DataFrame, from_date: str | date | None = None, to_date: str | date | None = None, skip_gold: bool = False
) -> DataFrame:
    """What a recovery would do, without writing: (step, crawl_date, product_count)."""
    days = (
        date_range(raw, from_date, to_date)
        .groupBy("crawl_date")
        .agg(F.count_distinct("id").alias("product_count"))
        .select(F.lit("replay").alias("step"), "crawl_date", "product_count")
    )
    if skip_gold:
        return days
    total = days.agg(
        F.lit("gold").alias("step"),
        F.max("crawl_date").alias("crawl_date"),
        F.sum("product_count").alias("product_count"),
    )
    return days.unionByName(total)


def recover(
    spark: SparkSession,
    lake: Lake,
    target: Lake,
    from_date: str | date | None = None,
    to_date: str | date | None = None,
    skip_gold: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Build log, state and aggregates anew in ``target``, beside the lake in use.

    The old tables stay until readers are pointed at the target, so a failed or partial
    recovery loses nothing. A range gives log and state of that range alone; ``recover_range``
    puts a range back among the other days. Returns the plan.
    """
    raw = lake.read_bronze(spark)
    plan = plan_recovery(raw, from_date, to_date, skip_gold)
    require_rows(date_range(raw, from_date, to_date), "raw table in the given range")
    if dry_run:
        return plan
    # log and state read the daily rows once each; they are deduplicated and shuffled once
    with staged_for_a_while(daily_rows(raw, from_date, to_date), "daily") as daily:
        snapshots = snapshots_of(raw, from_date, to_date)
        log, state = replayed(daily, snapshots)
        append_run(log, target.history, "recovery")
        state_table = target.state(spark)
        order = F.struct(F.col("_order.crawl_date").alias("day"), F.col("_order.loaded_at").alias("merged_at"), F.lit("").alias("run"))
        state_table.write_base(state, covered=snapshots.select("category_id", order.alias("_order")))
    if not skip_gold:
        write_gold(target, gold_tables(state_table.read(), target.read_history(spark), raw.drop("ingest")))
    return plan


def recover_range(
    spark: SparkSession,
    lake: Lake,
    target: Lake,
    from_date: str | date,
    to_date: str | date,
    skip_gold: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Replay the raw rows of a range of days only, and join the result with what came before and after.

    The state of the day before comes from the lake's state table, the days of the range from the
    raw table, and later rows from the runs of the state table. The log outside the range is kept
    but for its seam: of every product the first row after the range, which is compared anew with
    the last value before it. Equal to a full recovery where raw rows changed inside the range
    only; the runs of all later days, and a state of the day before, must not have expired.
    Builds beside the lake in use, as ``recover`` does, and returns the plan.
    """
    first, last = date.fromisoformat(str(from_date)), date.fromisoformat(str(to_date))
    raw = lake.read_bronze(spark)
    plan = plan_recovery(raw, first, last, skip_gold)
    require_rows(date_range(raw, first, last), "raw table in the given range")
    if dry_run:
        return plan
    table = lake.state(spark)
    before, covered_before = table.ordered_rows(before=first)
    later, covered_later = table.ordered_rows(after=last)
    run = F.lit("recovery").alias("run")
    place = F.struct(F.col("crawl_date").alias("day"), F.col("loaded_at").alias("merged_at"), run).alias("_order")
    with staged_for_a_while(daily_rows(raw, first, last).drop("ingest"), "range") as days:
        middle = days.select("*", place)
        seam = first_by(later, ["id"], ["_order"], tie_break=[])
        logged = changes_along(before, middle.unionByName(seam)).drop("_order")
        log = lake.read_history(spark).drop("run")
        outside = log.filter(~F.coalesce(F.col("crawl_date").between(F.lit(first), F.lit(last)), F.lit(False)))
        seen = seam.select(F.col("id").alias("_id"), F.col("crawl_date").alias("_day"), F.col("loaded_at").alias("_at"))
        again = (F.col("id") == F.col("_id")) & (F.col("crawl_date") == F.col("_day")) & (F.col("loaded_at") == F.col("_at"))
        append_run(outside.join(seen, again, "left_anti"), target.history, "kept")
        append_run(logged.select(outside.columns), target.history, "recovery")

        inside = date_range(raw, first, last).filter(F.col("id").isNotNull() & (F.col("ingest") == "batch"))
        covered = covered_before.unionByName(inside.select("category_id", place).distinct()).unionByName(covered_later)
        rows = before.unionByName(middle).unionByName(later)
        state = replay_state(rows, order="_order", full_snapshot=covered).drop("_order")
        state_table = target.state(spark)
        state_table.write_base(state, covered=covered)
    if not skip_gold:
        write_gold(target, gold_tables(state_table.read(), target.read_history(spark), raw.drop("ingest")))
    return plan
