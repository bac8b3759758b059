"""Reports over the state, the price log and the raw rows."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import day
from lakeops.functions.text import price_move
from lakeops.operators.history import with_previous
from lakeops.operators.latest import latest_by
from lakeops.plans.gold import DEEP_DISCOUNT


def price_moves(
    price_log: DataFrame,
    order: list[str] | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Each logged price with the one before it, the difference and the direction.

    A batch log has one row per product and day, the default order, so a product has no
    more rows than there are days. A stream log may have any number: give an order that
    tells its rows apart and a ``chunk`` that splits the rows of a product.
    """
    before = F.col("previous")["price"]
    return with_previous(price_log, ["id"], order or ["crawl_date"], ["price"], chunk).select(
        "id",
        "name",
        "crawl_date",
        F.col("price").alias("current_price"),
        before.alias("previous_price"),
        (F.col("price") - before).alias("price_diff"),
        price_move(F.col("price"), before).alias("price_trend"),
    )


def daily_sales(raw: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Units sold per day from a lifetime counter; the first day of a product counts 0.

    The latest-row step leaves one row per product and day, which bounds the rows per product.
    """
    columns = ["id", "name", "quantity_sold", "crawl_date", "loaded_at", *(tie_break or [])]
    narrow = raw.select(*columns) if tie_break is not None else raw
    daily = latest_by(narrow, ["id", "crawl_date"], ["loaded_at"], tie_break)
    before = F.col("previous")["quantity_sold"]
    return with_previous(daily, ["id"], ["crawl_date"], ["quantity_sold"]).select(
        "id",
        "name",
        "crawl_date",
        F.col("quantity_sold").alias("lifetime_sales"),
        before.alias("yesterday_lifetime_sales"),
        (F.col("quantity_sold") - F.coalesce(before, F.col("quantity_sold"))).alias("sales_today"),
    )


def daily_changes(price_log: DataFrame, raw: DataFrame) -> DataFrame:
    """Per day: products seen, first sightings, price changes, products without a change.

    A first sighting is the earliest date of a product, so it comes from an aggregate
    with partial sums and needs no ranking of all rows of a product.
    """
    first_seen = (
        price_log.groupBy("id")
        .agg(F.min("crawl_date").alias("crawl_date"))
        .groupBy("crawl_date")
        .agg(F.count(F.lit(1)).alias("new"))
    )
    logged = price_log.groupBy("crawl_date").agg(F.count(F.lit(1)).alias("logged"))
    seen = raw.groupBy("crawl_date").agg(F.count_distinct("id").alias("seen"))
    new = F.coalesce("new", F.lit(0))
    changed = F.coalesce("logged", F.lit(0)) - new
    return (
        seen.join(logged, "crawl_date", "left")
        .join(first_seen, "crawl_date", "left")
        .select(
            "crawl_date",
            F.col("seen").alias("total_products"),
            new.alias("new_products"),
            changed.alias("changed_products"),
            (F.col("seen") - new - changed).alias("unchanged_products"),
        )
    )


def changes_per_day(price_log: DataFrame) -> DataFrame:
    return price_log.groupBy("crawl_date").agg(F.count("id").alias("changed_products"))


def flash_sale_on(raw: DataFrame, on: str | date) -> DataFrame:
    """How many raw rows of one day are at least half off."""
    half_off = F.when(F.col("discount_rate") >= DEEP_DISCOUNT, 1).otherwise(0)
    return raw.filter(F.col("crawl_date") == day(on)).agg(F.sum(half_off).alias("flash_sale_products"))


def top_brands(products: DataFrame, n: int = 10, details: bool = True) -> DataFrame:
    """Brands with most products, by default with their average price, discount and rating."""
    measures = [F.count(F.lit(1)).alias("product_count")]
    if details:
        measures += [
            F.round(F.avg("price"), 0).alias("avg_price"),
            F.round(F.avg("discount_rate"), 2).alias("avg_discount_rate"),
            F.round(F.avg("rating_average"), 1).alias("avg_rating"),
        ]
    ranked = products.groupBy("brand_name").agg(*measures)
    return ranked.orderBy(F.col("product_count").desc(), "brand_name").limit(n)


def events_by_type(events: DataFrame, kind: str = "_event_type") -> DataFrame:
    return events.groupBy(kind).agg(F.count(F.lit(1)).alias("event_count"))


def metric_by(df: DataFrame, dimension: str, metric: Column, name: str, n: int = 10) -> DataFrame:
    """A chart: one aggregate by one dimension, greatest first, ``n`` rows."""
    return df.groupBy(dimension).agg(metric.alias(name)).orderBy(F.col(name).desc(), dimension).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def footer_counts(spark: SparkSession, paths: dict[str, str], column: str | None = None) -> DataFrame:
    """(table_name, row_count) of Parquet tables, and least and greatest value of a column, from file footers.

    The reader takes rows and extremes from the footers and reads no column.
    """
    option = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(option)
    # the aggregate goes down to the reader of the newer interface only
    spark.conf.set(option, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    finally:
        spark.conf.set(option, before)
    if column is None:
        return table_counts(tables)
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count(F.lit(1)).alias("row_count"), F.min(column).alias("least"), F.max(column).alias("greatest"))
            .select(F.lit(name).alias("table_name"), "row_count", "least", "greatest")
            for name, df in tables.items()
        ),
    )
