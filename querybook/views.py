"""The derived tables as DataFrames: products from line items and parts, stream events from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import day
from lakeops.operators.clean import partition_day
from lakeops.operators.history import as_of, change_log, replay_state
from lakeops.operators.latest import latest_by
from lakeops.schema import stored_schema

STORED = stored_schema().fieldNames()
TIE = [
    "l_orderkey", "l_linenumber", "l_suppkey", "price",
    "original_price", "discount_rate", "quantity_sold", "rating_average",
]
OLD, NEW = "2000-01-01", "2001-01-01"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def load_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as loads of a product on a day: the columns that change from load to load."""
    price = F.floor("l_extendedprice").cast("bigint")
    original = F.floor(F.col("l_extendedprice") * (1 + F.col("l_tax"))).cast("bigint")
    known = F.col("l_orderkey") % 23 != 0
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id"),
        price.alias("price"),
        F.when(known, original).alias("original_price"),
        F.when(known, original - price).alias("discount"),
        (F.floor(F.col("l_discount") * 100 + 0.5).cast("int") * 5).alias("discount_rate"),
        (3 + F.floor(F.col("l_tax") * 100 + 0.5) / 4).alias("rating_average"),
        (F.col("l_linenumber") * 5).alias("review_count"),
        F.col("l_quantity").cast("int").alias("quantity_sold"),
        F.lit(True).alias("is_active"),
        F.concat(F.lit("products_raw_"), F.year("l_shipdate"), F.lit("-01-01.json")).alias("source_file"),
        F.col("l_shipdate").alias("loaded_at"),
        F.trunc(F.col("l_shipdate").cast("date"), "year").alias("crawl_date"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
    )


def with_part(spark: SparkSession, sf: str, loads: DataFrame) -> DataFrame:
    """Loads with the columns that a product keeps: names, brand, category."""
    key = F.col("p_partkey")
    brand = (
        F.when(key % 13 == 0, "No Brand")
        .when(key % 17 == 0, " ")
        .when(key % 19 == 0, F.lit(None))
        .otherwise(F.col("p_brand"))
    )
    part = table(spark, sf, "part").select(
        key.alias("id"),
        F.concat(F.lit("SKU"), key).alias("sku"),
        F.col("p_name").alias("name"),
        F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("url_key"),
        brand.alias("brand_name"),
        F.concat(F.lit("/img/"), key, F.lit(".jpg")).alias("thumbnail_url"),
        F.col("p_size").alias("category_id"),
        F.col("p_type").alias("category_name"),
    )
    return loads.join(part, "id").select(*STORED, *[c for c in loads.columns if c not in STORED])


def products_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Product rows as loaded; several per product and day."""
    return with_part(spark, sf, load_rows(spark, sf))


def products_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The last load of each product and day, found before the product columns are joined."""
    last = latest_by(load_rows(spark, sf), ["id", "crawl_date"], ["loaded_at"], TIE)
    return with_part(spark, sf, last).select(STORED)


def price_history(spark: SparkSession, sf: str) -> DataFrame:
    return change_log(products_daily(spark, sf))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return replay_state(products_daily(spark, sf))


def state_before(spark: SparkSession, sf: str) -> DataFrame:
    """The state up to the day before the last, nothing deactivated."""
    return as_of(products_daily(spark, sf), ["id"], ["crawl_date"], day(OLD), tie_break=[])


def last_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot of the last day; the date filter goes below the latest-row step."""
    loads = partition_day(load_rows(spark, sf), NEW)
    last = latest_by(loads, ["id", "crawl_date"], ["loaded_at"], TIE)
    return with_part(spark, sf, last).select(STORED)


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as product records with some of the fields."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("SKU"), "p_partkey").alias("sku"),
        F.col("p_name").alias("name"),
        F.floor("p_retailprice").cast("bigint").alias("price"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_size").alias("category_id"),
        F.col("p_type").alias("category_name"),
        (F.col("p_size") * 2).alias("discount_rate"),
        (F.col("p_size") * 11).alias("quantity_sold"),
    )


def present(*items: Column) -> Column:
    """An array of the items that are not NULL."""
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def nested_products(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with a seller struct, a badge array and an array of category structs."""
    size = F.col("p_size")
    first = F.when(size % 2 == 0, F.struct(size.alias("id"), F.col("p_type").alias("name")))
    second = F.when(size % 5 == 0, F.struct((size + 100).alias("id"), F.col("p_brand").alias("name")))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("product_name"),
        F.struct(F.col("p_brand").alias("name"), (size % 2 == 0).alias("is_official")).alias("seller"),
        present(
            F.when(size > 25, "big"), F.when(size % 3 == 0, "free delivery"), F.when(F.col("p_type") == "PROMO", "promo")
        ).alias("badges"),
        present(first, second).alias("categories"),
    )


def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as product events, in three epochs by day of month."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    price = F.round(F.col("value") * 100).cast("bigint")
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("id"),
        F.concat(F.lit("user-"), "user_id").alias("name"),
        price.alias("price"),
        (price + k).alias("original_price"),
        F.when(k % 10 != 0, k).alias("discount"),
        (k % 60).cast("int").alias("discount_rate"),
        k.cast("int").alias("quantity_sold"),
        (F.col("user_id") % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") != "error", k % 17 != 0).alias("is_active"),
        F.col("ts").cast("date").cast("string").alias("crawl_date"),
        F.upper("event_type").alias("_event_type"),
        F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int").alias("epoch"),
    )
