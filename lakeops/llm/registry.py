"""The registry of the corpus queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its SQL."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def cleared(docs: DataFrame, *added: str) -> DataFrame:
    """``docs`` without columns named like those an operator adds, or that start with an underscore.

    The latter names are the operators' own.
    """
    taken = {name.lower() for name in added}
    return docs.drop(*(c for c in docs.columns if c.lower() in taken or c.startswith("_")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
