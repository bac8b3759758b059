"""Catalogue tables and reporting sinks."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from lakeops.sinks.files import existing_folders, remove_folders
from lakeops.sources.catalog import existing

Sink = Callable[[DataFrame], None]


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Add rows to a table, creating it when absent."""
    writer = df.write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def bucketed_table(df: DataFrame, name: str, folder: str, key: str, buckets: int) -> None:
    """A table of the catalogue, new or in place of an older one, whose files are split and sorted by key.

    Joins and groups by ``key`` over tables of as many buckets need no shuffle of either.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)


def create_or_replace(df: DataFrame, name: str, folder: str, keep: int = 2) -> str:
    """Write a new copy below ``folder``, then point the name at it.

    Readers see the old copy until the new one is whole. The name is a view, so the new
    copy may have other columns. The newest ``keep`` copies stay, so that a query that began
    on the copy before can end. Returns the path of the new copy.
    """
    if keep < 1:
        raise ValueError("the copy in use has to stay")
    spark = df.sparkSession
    # names sort by the time of their copy
    path = f"{folder.rstrip('/')}/copy-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    copies = sorted(existing_folders(spark, f"{folder.rstrip('/')}/copy-*"))
    remove_folders(spark, copies[:-keep])
    return path


def table_sink(name: str, folder: str) -> Sink:
    def write(df: DataFrame) -> None:
        create_or_replace(df, name, folder)

    return write


def jdbc_sink(url: str, table: str, properties: dict[str, str], mode: str = "overwrite") -> Sink:
    """A reporting database table. Overwriting empties it and keeps its definition."""

    def write(df: DataFrame) -> None:
        options = {**properties, "truncate": "true"} if mode == "overwrite" else properties
        df.write.jdbc(url=url, table=table, mode=mode, properties=options)

    return write


def publish(df: DataFrame, sinks: Iterable[Sink]) -> None:
    """Compute ``df`` once and write it to every sink."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()


def drop_tables(spark: SparkSession, names: list[str], really: bool = False) -> DataFrame:
    """The named tables and whether each exists; they are dropped only when ``really`` is set."""
    plan = existing(spark, names)
    for name in names:
        if really and spark.catalog.tableExists(name):
            kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} {name}")
    return plan
