"""Where the tables of one lake live."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.schema import LOAD_FIELDS, product_schema
from lakeops.sinks.state import StateTable, read_or_empty


@dataclass(frozen=True)
class Lake:
    """Folders below one root: raw rows, price log, state, speed layer, aggregates.

    ``extra`` are (name, type) of fields that are stored beside those of a product.
    """

    root: str
    extra: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> StructType:
        return product_schema({**LOAD_FIELDS, **dict(self.extra)})

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self._at("bronze/products_raw")

    @property
    def history(self) -> str:
        return self._at("silver/price_history")

    @property
    def speed(self) -> str:
        return self._at("speed/realtime_events")

    @property
    def quarantine(self) -> str:
        return self._at("quarantine/events")

    def gold(self, name: str) -> str:
        return self._at(f"gold/{name}")

    def state(self, spark: SparkSession) -> StateTable:
        return StateTable(spark, self._at("silver/products"), self.schema)

    def read_bronze(self, spark: SparkSession, day: date | None = None) -> DataFrame:
        """The raw table; with ``day`` only that day's partition is read."""
        stored = read_or_empty(spark, self.bronze, StructType(self.schema.fields).add("ingest", "string"))
        return stored if day is None else stored.filter(F.col("crawl_date") == F.lit(day))

    def read_history(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.history, StructType(self.schema.fields).add("run", "string"))
