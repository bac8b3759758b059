"""The stream job: events to raw table, price log, state and speed layer, epoch by epoch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.changes import detect_changes, drop_stale
from lakeops.operators.clean import clean_records, split_errors, stamp_events
from lakeops.operators.latest import latest_by
from lakeops.plans.gold_parts import GoldParts
from lakeops.plans.lake import Lake
from lakeops.schema import SPEED_COLUMNS
from lakeops.sinks.files import append_run, epoch_name, write_bronze
from lakeops.sinks.tables import Sink
from lakeops.sources.messages import MESSAGE_COLUMNS
from lakeops.streaming.run import Handler


def medallion_handler(
    lake: Lake,
    order: list[str],
    name: str = "stream",
    event_only: list[str] | None = None,
    default_active: bool | None = True,
    error: str | None = None,
    newer_by: str | None = None,
    speed_sinks: Sequence[Sink] = (),
    before_last: Callable[[int], None] | None = None,
    renew_every: int | None = 500,
    longest_load: timedelta = timedelta(hours=6),
    keep_gold: bool = False,
) -> Handler:
    """A micro-batch function that may be repeated for the same epoch.

    ``order`` says which of several events of one id is the latest, such as the message's
    ``_timestamp`` and ``_offset``; ``event_only`` are columns that do not go into the stored
    row. Everything is keyed by epoch, so a repeated epoch replaces its rows, and changes
    are always found against the state without this epoch. All writes only add; reading the
    state for the changes looks at the epoch's ids alone.

    Rows with a text in column ``error`` go to the quarantine. The latest day of a product wins,
    and of one day the last arrival: an event of an older day than the product's row changes
    neither state nor log, and a recovery puts it at its day. With ``newer_by``, a column of the
    stored row, older events never overwrite newer state inside a day either.

    Every ``renew_every`` epochs the state is written as a new base, as of ``longest_load`` ago,
    so that what an epoch reads does not grow with the age of the stream; a load of any kind has
    to be done within that time.

    With ``keep_gold`` the sums of the aggregates over products and log follow every epoch; the
    summaries of days are left to ``GoldParts.add_days``. ``speed_sinks`` also receive the speed rows of every epoch; one that only appends, such as a
    database table, gets them again when an epoch is repeated, and can tell by their ``run``.
    ``before_last`` is called with the epoch before its last write.
    """
    if not order:
        raise ValueError("without an order the latest of several events of one id is not known")
    stored = set(lake.schema.fieldNames())
    dropped = [*(event_only or []), "_event_type", *(c for c in MESSAGE_COLUMNS if c not in stored)]

    seen: set[int] = set()

    def handle(batch: DataFrame, epoch: int) -> None:
        state = lake.state(batch.sparkSession)
        run = epoch_name(name, epoch)
        with held(batch) as batch:
            broken = F.count(error) if error else F.lit(0)
            rows, bad_rows = batch.agg(F.count(F.lit(1)), broken).first()
            if rows == 0:
                return
            good = batch
            if error:
                good, bad = split_errors(batch, error)
                if bad_rows:
                    append_run(bad.select(error), lake.quarantine, run)
            # one load time per epoch, taken here, so a recomputed partition gets the same value
            now = datetime.now()
            events = stamp_events(good, name, now, default_active)
            speed = events.select(*SPEED_COLUMNS)
            append_run(speed, lake.speed, run)
            for sink in speed_sinks:
                sink(speed.withColumn("run", F.lit(run)))
            with held(latest_by(events, ["id"], order).drop(*dropped)) as latest:
                write_bronze(latest, lake.bronze, ingest=run)
                cleaned = clean_records(latest)
                with held(state.read(without=run, keys=cleaned)) as current:
                    for order_by in ("crawl_date", *([newer_by] if newer_by else [])):
                        cleaned = drop_stale(cleaned, current, order_by)
                    with held(cleaned) as cleaned:
                        append_run(detect_changes(cleaned, current), lake.history, run)
                        if keep_gold:
                            logged = lake.read_history(batch.sparkSession).filter(F.col("run") == run)
                            GoldParts(batch.sparkSession, lake).add(run, cleaned, current, logged)
                        if before_last:
                            before_last(epoch)
                        state.append(cleaned, run, now, may_be_repeated=not seen or epoch in seen)
            seen.add(epoch)
            if renew_every and len(seen) % renew_every == 0:
                state.renew_base(now - longest_load)

    return handle


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept for several uses; lost pieces are computed again from the epoch's fixed input."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
