"""Catalogue look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.guards import require_table


def list_databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def describe(spark: SparkSession, tables: list[str]) -> DataFrame:
    """(table_name, column_name, data_type) of the named tables."""
    rows = [
        (table, field.name, field.dataType.simpleString())
        for table in tables
        for field in require_table(spark, table).schema
    ]
    return spark.createDataFrame(rows, "table_name STRING, column_name STRING, data_type STRING")


def existing(spark: SparkSession, tables: list[str]) -> DataFrame:
    """(table_name, present) for each name."""
    rows = [(table, spark.catalog.tableExists(table)) for table in tables]
    return spark.createDataFrame(rows, "table_name STRING, present BOOLEAN")
