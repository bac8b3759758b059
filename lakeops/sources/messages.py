"""Keyed JSON messages: sources, decoding, bounded drains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

from lakeops.schema import event_schema
from lakeops.streaming.run import start

# what a message carries beside its text; NULL in sources that do not know it
MESSAGE_SCHEMA = "key STRING, value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
MESSAGE_COLUMNS = ["_partition", "_offset", "_timestamp"]


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    """Options of the Kafka source: subscribe, start position, no failure on lost data."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """A topic as a stream of messages with key and value as text; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting)).load()
    return raw.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset", "timestamp"
    )


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files with messages as a stream."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def decode(messages: DataFrame, schema: StructType | None = None, error: str | None = None) -> DataFrame:
    """Message values as columns; with ``error``, values that are no JSON object are kept there.

    Fields are read as text and then cast, so that a field of the wrong type is NULL and the
    others stay. A counter may come as a number or as an object that holds its value. Where
    a message carries them, its partition, offset and time follow as ``MESSAGE_COLUMNS``.
    """
    schema = schema or event_schema()
    texts = StructType().add("_broken", "string")
    for field in schema:
        texts = texts.add(field.name, "string")
    value = F.col("value").cast("string")
    item = F.from_json(value, texts, {"columnNameOfCorruptRecord": "_broken"}).alias("_item")
    known = [c for c in MESSAGE_COLUMNS if c[1:] in messages.columns]
    parsed = messages.select(item, value.alias("_value"), *(F.col(c[1:]).alias(c) for c in known))

    def typed(field: StructField) -> Column:
        text = F.col("_item")[field.name]
        if isinstance(field.dataType, IntegralType):
            # most counters are plain numbers, which need no second parse
            text = F.when(F.contains(text, F.lit("{")), F.coalesce(F.get_json_object(text, "$.value"), text)).otherwise(text)
        return text.try_cast(field.dataType).alias(field.name)

    whole = F.col("_item").isNotNull() & F.col("_item._broken").isNull() & F.col("_value").rlike(r"^\s*\{")
    broken = F.when(~F.coalesce(whole, F.lit(False)), F.coalesce("_value", F.lit("")))
    errors = [broken.alias(error)] if error else []
    return parsed.select(*map(typed, schema), *errors, *known)


def drain(messages: DataFrame, folder: str, checkpoint: str, must_have_rows: bool = False) -> str:
    """Write all messages that are available now as NDJSON below ``folder`` and stop.

    The checkpoint remembers what was taken, so the next drain, into another folder,
    starts after it. A repeated epoch replaces its own files.
    """
    taken: list[int] = []

    def write(batch: DataFrame, epoch: int) -> None:
        batch.select("value").write.mode("overwrite").text(f"{folder}/drain-{epoch:09d}")
        taken.append(epoch)

    start(messages, write, checkpoint, every=None).awaitTermination()
    if must_have_rows and not taken:
        raise ValueError("no messages were available")
    return folder
