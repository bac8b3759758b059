"""File sinks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import scratch_path


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions of ``by`` that are present in ``df``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def write_bronze(df: DataFrame, path: str, ingest: str = "batch", many_days: bool = False) -> None:
    """Replace the (day, ingest) partitions present in ``df``.

    ``ingest`` names the writer. The batch writer replaces its own rows of a day and never
    those a stream appended; a stream that uses one name per epoch may repeat an epoch.
    ``many_days`` first brings the rows of a day together, so that not every task writes a
    file for every day; a day with too many rows for one task is split again.
    """
    if many_days:
        df = df.hint("rebalance", "crawl_date")
    write_partitions(df.withColumn("ingest", F.lit(ingest)), path, ["crawl_date", "ingest"])


def run_folder(path: str, run: str) -> str:
    """The folder of one run; characters that mean something in a path are escaped as Spark does."""
    plain = "".join(c if c.isalnum() or c in "-_. " or ord(c) > 127 else f"%{ord(c):02X}" for c in run)
    return f"{path.rstrip('/')}/run={plain}"


def append_run(df: DataFrame, path: str, run: str) -> None:
    """Add the rows of one run to an append-only table, as column ``run``; repeating a run replaces its rows.

    A run has a folder of its own, which a repeated run overwrites, also with no row at all.
    """
    df.write.mode("overwrite").parquet(run_folder(path, run))


def epoch_name(name: str, epoch: int) -> str:
    """The partition value of one epoch of a stream; values sort in epoch order."""
    return f"{name}-{epoch:09d}"


@contextmanager
def staged_for_a_while(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder for several reads, and removed afterwards."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_folders(df.sparkSession, [path])


def existing_folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders or files that match a pattern with ``*``, without reading below them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(path)
    return [f.getPath().toString() for f in found] if found is not None else []


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders on whatever file system they are on."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        target = hadoop.Path(folder)
        target.getFileSystem(conf).delete(target, True)


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, by: list[str] | None = None, single_file: bool = False) -> None:
    """CSV with a header, optionally one folder per value of ``by`` or one file."""
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_ndjson(df: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON object per line; readers know a compression by the names of the files."""
    df.write.mode("overwrite").option("compression", compression).json(path)


def to_messages(df: DataFrame, key: str = "id", crawl_date: str | None = None) -> DataFrame:
    """Rows as (key, value) messages, the date stamped into the value when given."""
    if crawl_date is not None:
        df = df.withColumn("crawl_date", F.lit(crawl_date))
    value = F.to_json(F.struct(*df.columns))
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def publish_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Send (key, value) rows to a topic; needs the Kafka connector on the class path."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("kafka.acks", "all").option("topic", topic).save()
