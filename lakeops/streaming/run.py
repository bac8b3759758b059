"""Starting a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

Handler = Callable[[DataFrame, int], None]


def without_repeats(events: DataFrame, keys: list[str], time: str = "_timestamp", within: str = "1 hour") -> DataFrame:
    """Each event once, also if it is sent again in a later epoch or after a restart.

    The keys of the last ``within`` of event time are kept as state of the stream. What is
    older than that, against the newest event seen, counts as late and is left out. Events that
    could not be decoded have no key of their own: name the column with their text as a key too.
    """
    return events.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


def start(
    events: DataFrame,
    handler: Handler,
    checkpoint: str,
    every: str | None = "20 seconds",
) -> StreamingQuery:
    """Run ``handler`` per micro-batch; ``every`` None takes what is available now and stops."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = events.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
