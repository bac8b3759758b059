"""The stream job over the events table, fed as three batches of messages."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.latest import latest_by
from lakeops.plans.batch import run_batch
from lakeops.plans.lake import Lake
from lakeops.plans.recovery import recover
from lakeops.plans.reports import events_by_type
from lakeops.schema import event_schema
from lakeops.session import scratch_path
from lakeops.sinks.files import to_messages, write_ndjson
from lakeops.sources.files import read_records
from lakeops.sources.messages import decode, drain, file_messages
from lakeops.streaming.micro_batch import medallion_handler
from lakeops.streaming.run import start, without_repeats
from querybook import views
from querybook.book import query

EPOCHS = 3
#: messages of a file; an epoch is then read by all cores, however few tasks wrote it
MESSAGES = 50_000


def send(spark, sf, folder: str, epoch: int, mixed_counters: bool = True) -> None:
    """Add the messages of one epoch to the folder a stream reads; counters come as numbers and as objects."""
    events = views.stream_events(spark, sf).filter(F.col("epoch") == epoch).drop("epoch")
    messages = to_messages(events)
    as_object = F.regexp_replace("value", '"quantity_sold":([0-9]+)', '"quantity_sold":{"value":$1}')
    if mixed_counters:
        messages = messages.withColumn("value", F.when(F.xxhash64("key") % 2 == 0, as_object).otherwise(F.col("value")))
    messages.write.mode("append").option("maxRecordsPerFile", MESSAGES).parquet(folder)


class FailedOnce(Exception):
    """Raised by the restart query after an epoch has written its data."""


def run_stream(spark, sf, label: str, fail_in_epoch: int | None = None, **options) -> Lake:
    """Send and process the epochs one after the other, each run resuming from the checkpoint."""
    root = scratch_path(spark, label)
    lake = Lake(f"{root}/lake")
    handler = medallion_handler(lake, order=["event_id"], event_only=["event_id"], error="_error", **options)
    for epoch in range(EPOCHS):
        send(spark, sf, f"{root}/in", epoch)
        events = decode(file_messages(spark, f"{root}/in"), event_schema({"event_id": "long"}), error="_error")
        if epoch == fail_in_epoch:
            # the raw rows, log and speed rows of the epoch are written, its state rows are not
            failing = medallion_handler(
                lake, order=["event_id"], event_only=["event_id"], error="_error", before_last=fail
            )
            query = start(events, failing, f"{root}/checkpoint", every=None)
            try:
                query.awaitTermination()
            except Exception as error:  # the stream reports a failed handler as its own error
                if FailedOnce.__name__ not in str(error):
                    raise
        start(events, handler, f"{root}/checkpoint", every=None).awaitTermination()
    return lake


def fail(epoch: int) -> None:
    raise FailedOnce(f"epoch {epoch}")


@query(
    "stream_events",
    "SELECT id, name, price, discount_rate, quantity_sold, _event_type FROM stream_events",
)
def _(spark, sf):
    lake = run_stream(spark, sf, "stream-events")
    return spark.read.parquet(lake.speed).select(
        "id", "name", "price", "discount_rate", "quantity_sold", "_event_type"
    )


@query("speed_layer", "SELECT _event_type, count(*) AS event_count FROM stream_events GROUP BY _event_type")
def _(spark, sf):
    lake = run_stream(spark, sf, "stream-speed")
    return events_by_type(spark.read.parquet(lake.speed))


REPEATED = ["id", "name", "price", "discount_rate", "quantity_sold", "_event_type"]


@query(
    "stream_repeated",
    f"""
    SELECT 'speed' AS part, {", ".join(REPEATED)} FROM stream_events
    UNION ALL SELECT 'log', id, name, price, discount_rate, quantity_sold, NULL FROM stream_log""",
)
def _(spark, sf):
    # a third of an epoch's messages come again in each later one, every run resuming from the checkpoint
    root = scratch_path(spark, "stream-repeated")
    lake = Lake(f"{root}/lake")
    handler = medallion_handler(lake, order=["event_id"], event_only=["event_id"], error="_error")
    all_events = views.stream_events(spark, sf)
    for epoch in range(EPOCHS):
        events = all_events.filter((F.col("epoch") == epoch) | (F.col("epoch") < epoch) & (F.col("event_id") % 3 == 0))
        timed = to_messages(events.drop("epoch")).withColumn("timestamp", F.to_timestamp(F.get_json_object("value", "$.crawl_date")))
        timed.write.mode("append").option("maxRecordsPerFile", MESSAGES).parquet(f"{root}/in")
        decoded = decode(file_messages(spark, f"{root}/in"), event_schema({"event_id": "long"}), error="_error")
        once = without_repeats(decoded, ["event_id"], within="60 days")
        start(once, handler, f"{root}/checkpoint", every=None).awaitTermination()
    speed = spark.read.parquet(lake.speed).select(F.lit("speed").alias("part"), *REPEATED)
    log = lake.read_history(spark).withColumn("_event_type", F.lit(None).cast("string"))
    return speed.unionByName(log.select(F.lit("log").alias("part"), *REPEATED))


STATE = ["id", "name", "price", "original_price", "discount", "discount_rate", "quantity_sold", "category_id", "crawl_date"]


@query(
    "stream_state",
    f"""
    SELECT {", ".join(STATE)}, coalesce(is_active, true) AS is_active FROM stream_events
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1""",
)
def _(spark, sf):
    lake = run_stream(spark, sf, "stream-state")
    return lake.state(spark).read().select(*STATE, "is_active")


@query(
    "stream_state_renewed",
    f"""
    SELECT {", ".join(STATE)}, coalesce(is_active, true) AS is_active, 1 AS bases FROM stream_events
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1""",
)
def _(spark, sf):
    # a new base after every epoch; all but the last one expire, with the runs before it
    lake = run_stream(spark, sf, "stream-renewed", renew_every=1, longest_load=timedelta(0))
    state = lake.state(spark)
    state.expire(1)
    return state.read().select(*STATE, "is_active", F.lit(len(state.bases())).alias("bases"))


LOG = f"SELECT {', '.join(STATE)}, epoch FROM stream_log"


def logged(spark, lake: Lake):
    rows = lake.read_history(spark)
    return rows.select(*STATE, F.substring_index("run", "-", -1).cast("int").alias("epoch"))


@query(
    "recover_state",
    f"""
    WITH newest AS (
        SELECT * EXCLUDE (is_active), coalesce(is_active, true) AS is_active FROM stream_events
        QUALIFY row_number() OVER (PARTITION BY id, epoch ORDER BY event_id DESC) = 1),
    batch AS (SELECT * FROM newest WHERE epoch = 1 AND id % 3 <> 0),
    merged AS (SELECT *, 0 AS step FROM newest WHERE epoch = 0
               UNION ALL SELECT * REPLACE (true AS is_active), 1 FROM batch
               UNION ALL SELECT *, 2 FROM newest WHERE epoch = 2)
    SELECT {", ".join(c for c in STATE if c != "crawl_date")},
           is_active AND NOT (step < 1 AND category_id IN (SELECT category_id FROM batch)) AS is_active, origin
    FROM (SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY id ORDER BY step DESC) = 1),
         (VALUES ('live'), ('recovered')) o(origin)""",
)
def _(spark, sf):
    live, recovered = recovered_lake(spark, sf, "recover-state", skip_gold=True)
    picked = [c for c in STATE if c != "crawl_date"] + ["is_active"]
    both = ((lake.state(spark).read().select(*picked), origin) for lake, origin in ((live, "live"), (recovered, "recovered")))
    return reduce(DataFrame.unionByName, (df.withColumn("origin", F.lit(origin)) for df, origin in both))


def recovered_lake(spark, sf, label: str, skip_gold: bool = False) -> tuple[Lake, Lake]:
    """A lake fed by a stream epoch, a batch and a stream epoch, on a day each, and its recovery."""
    root = scratch_path(spark, label)
    live, recovered = Lake(f"{root}/live"), Lake(f"{root}/recovered")
    handler = medallion_handler(live, order=["event_id"], event_only=["event_id", "epoch"], default_active=True)
    missing = ("sku", "url_key", "brand_name", "thumbnail_url", "category_name")
    events = views.stream_events(spark, sf).withColumns(dict.fromkeys(missing, F.lit(None).cast("string")))
    events = events.withColumns({"rating_average": F.lit(4.0), "review_count": F.lit(20)})
    for epoch, day in enumerate(("2024-03-01", "2024-03-02", "2024-03-03")):
        part = events.filter(F.col("epoch") == epoch).withColumn("crawl_date", F.lit(day))
        if epoch != 1:
            handler(part, epoch)
            continue
        latest = latest_by(part.filter("id % 3 <> 0"), ["id"], ["event_id"])
        path = f"{root}/products_raw_{day}.json"
        write_ndjson(latest.drop("event_id", "epoch", "_event_type", "crawl_date"), path)
        run_batch(spark, path, live)
    recover(spark, live, recovered, skip_gold=skip_gold)
    return live, recovered


@query(
    "recover_gold",
    """
    WITH newest AS (
        SELECT * FROM stream_events QUALIFY row_number() OVER (PARTITION BY id, epoch ORDER BY event_id DESC) = 1),
    daily AS (SELECT *, epoch AS step FROM newest WHERE epoch <> 1 OR id % 3 <> 0),
    log AS (SELECT * FROM daily
            WINDOW h AS (PARTITION BY id ORDER BY step)
            QUALIFY row_number() OVER h = 1 OR price <> lag(price) OVER h OR original_price <> lag(original_price) OVER h
                 OR discount <> lag(discount) OVER h OR discount_rate <> lag(discount_rate) OVER h)
    SELECT CAST(DATE '2024-03-01' + step AS DATE) AS crawl_date, category_id, count(*) AS total_price_changes,
           min(price) AS min_new_price, max(price) AS max_new_price
    FROM log GROUP BY ALL""",
)
def _(spark, sf):
    recovered_lake(spark, sf, "recover-gold")
    # the aggregates are tables of the catalogue
    return spark.table("gold_price_trend").select(
        "crawl_date", "category_id", "total_price_changes", "min_new_price", "max_new_price"
    )


@query("stream_history", LOG)
def _(spark, sf):
    return logged(spark, run_stream(spark, sf, "stream-history"))


@query("stream_restart", LOG)
def _(spark, sf):
    return logged(spark, run_stream(spark, sf, "stream-restart", fail_in_epoch=1))


@query(
    "drain_available",
    "SELECT id, name, price, quantity_sold, is_active, CASE epoch WHEN 0 THEN 'first' ELSE 'second' END AS batch FROM stream_events",
)
def _(spark, sf):
    root = scratch_path(spark, "drain")
    drained = []
    for batch, epochs in (("first", [0]), ("second", [1, 2])):
        for epoch in epochs:
            send(spark, sf, f"{root}/in", epoch, mixed_counters=False)
        folder = drain(file_messages(spark, f"{root}/in"), f"{root}/{batch}", f"{root}/checkpoint")
        drained.append(read_records(spark, folder).withColumn("batch", F.lit(batch)))
    return drained[0].unionByName(drained[1]).select("id", "name", "price", "quantity_sold", "is_active", "batch")
