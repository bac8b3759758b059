"""The batch job: raw file to raw table, price log, state and aggregates."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.guards import require_date, require_rows
from lakeops.operators.changes import detect_changes
from lakeops.operators.clean import clean_records, stamp_batch
from lakeops.operators.history import change_log
from lakeops.operators.latest import latest_by
from lakeops.plans.gold import gold_tables
from lakeops.plans.gold_parts import GoldParts
from lakeops.plans.lake import Lake
from lakeops.schema import product_schema
from lakeops.sinks.files import append_run, remove_folders, run_folder, staged_for_a_while, write_bronze
from lakeops.sinks.tables import Sink, publish, table_sink
from lakeops.sources.files import read_records


def load_bronze(
    spark: SparkSession, path: str, lake: Lake, loaded_at: datetime | None = None, own_dates: bool = False
) -> None:
    """One dated NDJSON file (or folder) into the raw table, one row per id.

    With ``own_dates`` a record's own ``crawl_date`` wins over the file's, one row per id and
    day; such older days enter log and state through a recovery, which replays all days.
    """
    name = os.path.basename(path.rstrip("/"))
    if not own_dates:
        records = latest_by(read_records(spark, path), ["id"], [])
        write_bronze(stamp_batch(records, name, loaded_at), lake.bronze)
        return
    records = read_records(spark, path, product_schema({"crawl_date": "string"}))
    stamped = stamp_batch(records, name, loaded_at, own_date="crawl_date")
    write_bronze(latest_by(stamped, ["id", "crawl_date"], []), lake.bronze, many_days=True)


def load_silver(
    spark: SparkSession,
    day: date,
    lake: Lake,
    run: str,
    at: datetime | None = None,
    parts: GoldParts | None = None,
) -> None:
    """The batch rows of one day into the state, as a full snapshot, and their changes into the price log.

    The snapshot is written first and read back, so it is cleaned once; changes are found
    against the state without this run. A run can be repeated under the same ``run`` name, also
    with other data, and replaces what it wrote. A day that is loaded again, or for the first
    time, after later days takes its place before them, and the log is written anew from there.
    """
    state = lake.state(spark)
    raw = lake.read_bronze(spark, day).filter(F.col("ingest") == "batch").drop("ingest")
    state.append(clean_records(latest_by(raw, ["id"], ["loaded_at"])), run, at, snapshot=True)
    newest = state.newest_day(without=run)
    if newest is not None and newest > day:
        log_again(spark, lake, day)
        if parts:
            parts.rebuild(state.read(), lake.read_history(spark))
    else:
        snapshot, before = state.rows_of(run), state.read(without=run)
        append_run(detect_changes(snapshot, before), lake.history, run)
        if parts:
            logged = lake.read_history(spark).filter(F.col("run") == run)
            parts.add(run, snapshot, before.join(snapshot.select("id"), "id", "left_semi"), logged)
    if parts:
        parts.add_days([day])


def log_again(spark: SparkSession, lake: Lake, since: date) -> None:
    """The price log of all runs from a day on, from the rows of the runs and the state before that day.

    One pass over these rows, however many runs there are; it can be repeated if it fails.
    """
    state = lake.state(spark)
    runs = state.ordered_rows(after=since - timedelta(days=1))[0]
    before = state.ordered_rows(before=since)[0]
    logged = changes_along(before, runs).withColumn("run", F.col("_order.run")).drop("_order")
    with staged_for_a_while(logged, "log") as logged:
        names = [r[0] for r in runs.select("_order.run").distinct().collect()]
        remove_folders(spark, [run_folder(lake.history, name) for name in names])
        logged.write.mode("append").partitionBy("run").parquet(lake.history)


def changes_along(before: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of ``rows`` that are new or differ from the row of their product before, in the order ``_order``.

    Of ``before``, which comes before all of them, the last row of a product counts.
    """
    last = latest_by(before, ["id"], ["_order"], tie_break=[])
    both = last.withColumn("_logged", F.lit(False)).unionByName(rows.withColumn("_logged", F.lit(True)))
    return change_log(both, order="_order").filter("_logged").drop("_logged")


def run_batch(
    spark: SparkSession,
    path: str,
    lake: Lake,
    layer: str = "all",
    run: str | None = None,
    loaded_at: datetime | None = None,
    own_dates: bool = False,
    keep_gold: bool = False,
) -> None:
    """Load one file; ``layer`` is bronze, silver or all. With ``keep_gold`` the sums of the aggregates follow.

    A run is named after its day, so that repeating it replaces what it wrote; several loads
    of one day that shall all stay in the price log need a ``run`` name each.
    """
    if layer not in ("all", "bronze", "silver"):
        raise ValueError(f"unknown layer {layer!r}")
    day = require_date(os.path.basename(path.rstrip("/")))
    loaded_at = loaded_at or datetime.now()
    if layer != "silver":
        require_rows(read_records(spark, path), path)
        load_bronze(spark, path, lake, loaded_at, own_dates)
    if layer != "bronze":
        parts = GoldParts(spark, lake) if keep_gold else None
        load_silver(spark, day, lake, run or f"batch-{day}", loaded_at, parts)


def write_gold(
    lake: Lake, tables: dict[str, DataFrame], extra: dict[str, list[Sink]] | None = None
) -> None:
    """Write each aggregate, computed once, to the lake and to its extra sinks."""
    for name, df in tables.items():
        publish(df, [table_sink(f"gold_{name}", lake.gold(name)), *(extra or {}).get(name, [])])


def run_gold(
    spark: SparkSession, lake: Lake, extra: dict[str, list[Sink]] | None = None, dry_run: bool = False
) -> dict[str, DataFrame]:
    """The five aggregates over the current tables, written unless ``dry_run``."""
    state = lake.state(spark)
    if state.is_empty():
        raise ValueError("the state is empty; load a batch first")
    tables = gold_tables(state.read(), lake.read_history(spark), lake.read_bronze(spark))
    if not dry_run:
        write_gold(lake, tables, extra)
    return tables


def run_all(
    spark: SparkSession, paths: list[str], lake: Lake, loaded_at: Callable[[str], datetime] | None = None
) -> dict[str, DataFrame]:
    """Dated files in order, then the aggregates. ``loaded_at`` gives a load time for a path."""
    for path in sorted(paths, key=lambda p: require_date(os.path.basename(p.rstrip("/")))):
        run_batch(spark, path, lake, loaded_at=loaded_at(path) if loaded_at else None)
    return run_gold(spark, lake)
