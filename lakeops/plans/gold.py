"""The five business aggregates, as pure functions of the tables they read.

Results carry no ORDER BY: order is not kept by a table, so sort when presenting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.pricing import in_thousands, popularity_score
from lakeops.functions.text import NO_BRAND
from lakeops.operators.latest import latest_by

# Thresholds of the business questions.
DEEP_DISCOUNT = 50
GOOD_DISCOUNT = 30
MIN_REVIEWS = 10
MIN_RATING = 3.5
TOP_PRODUCTS = 100

GROUP = ["category_id", "category_name", "brand_name"]


def _mean(column: str, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def _at_least(column: str, threshold: int) -> Column:
    """How many rows reach the threshold; 0, not NULL, where none does."""
    return F.sum(F.when(F.col(column) >= threshold, 1).otherwise(0))


def _distinct_ids(unique_ids: bool) -> Column:
    """Distinct ids; a plain count where the table is known to hold one row per id,
    which saves the shuffle of every (group, id) pair."""
    return F.count("id") if unique_ids else F.count_distinct("id")


def _live(products: DataFrame, active_only: bool) -> DataFrame:
    return products.filter("is_active") if active_only else products


def brand_performance(products: DataFrame, unique_ids: bool = False, active_only: bool = False) -> DataFrame:
    """Which brand leads in each category: products, units, ratings, prices."""
    brand = F.col("brand_name")
    branded = brand.isNotNull() & (brand != NO_BRAND) & (F.trim(brand) != "")
    return (
        _live(products, active_only)
        .filter(branded & (F.col("quantity_sold") > 0))
        .groupBy(*GROUP)
        .agg(
            _distinct_ids(unique_ids).alias("total_products"),
            F.sum("quantity_sold").alias("total_quantity_sold"),
            _mean("rating_average", 2).alias("avg_rating"),
            _mean("review_count", 0).alias("avg_reviews"),
            _mean("price", 0).alias("avg_price"),
            _mean("discount_rate", 1).alias("avg_discount_rate"),
            F.max("crawl_date").alias("last_updated"),
        )
    )


def price_trend(price_log: DataFrame) -> DataFrame:
    """How prices and promotions move per day and category, over the change log."""
    return price_log.groupBy("crawl_date", "category_id", "category_name").agg(
        F.count("id").alias("total_price_changes"),
        _mean("price", 0).alias("avg_new_price"),
        F.round(F.min("price"), 0).alias("min_new_price"),
        F.round(F.max("price"), 0).alias("max_new_price"),
        _mean("discount_rate", 1).alias("avg_new_discount_rate"),
    )


def discount_analysis(products: DataFrame, unique_ids: bool = False, active_only: bool = False) -> DataFrame:
    """Which category and brand discount most, over discounted products."""
    return (
        _live(products, active_only)
        .filter(F.col("discount_rate") > 0)
        .groupBy(*GROUP)
        .agg(
            _distinct_ids(unique_ids).alias("product_count"),
            _mean("discount_rate", 1).alias("avg_discount_rate"),
            F.max("discount_rate").alias("max_discount_rate"),
            _at_least("discount_rate", GOOD_DISCOUNT).alias("products_30pct_off"),
            _at_least("discount_rate", DEEP_DISCOUNT).alias("products_50pct_off"),
            _mean("price", 0).alias("avg_current_price"),
            _mean("original_price", 0).alias("avg_original_price"),
            F.max("crawl_date").alias("last_updated"),
        )
    )


def top_products(products: DataFrame, n: int = TOP_PRODUCTS, active_only: bool = False) -> DataFrame:
    """The most popular well-reviewed products; equal scores are ordered by id."""
    score = popularity_score(
        F.col("quantity_sold"), F.col("rating_average"), F.col("review_count"), F.col("discount_rate")
    )
    return (
        _live(products, active_only)
        .filter((F.col("review_count") >= MIN_REVIEWS) & (F.col("rating_average") >= MIN_RATING))
        .select(
            "id",
            "name",
            "brand_name",
            "category_id",
            "category_name",
            in_thousands(F.col("price")).alias("price_k"),
            in_thousands(F.col("original_price")).alias("original_price_k"),
            "discount_rate",
            "rating_average",
            "review_count",
            "quantity_sold",
            "url_key",
            "thumbnail_url",
            F.col("crawl_date").alias("last_updated"),
            score.alias("popularity_score"),
        )
        .orderBy(F.col("popularity_score").desc(), "id")
        .limit(n)
    )


def daily_summary(raw: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Per day, over the last load of each product: products, brands, categories, prices, units.

    After the latest-row step a product counts once per day, so counting ids needs no
    DISTINCT. Rows are then reduced to one per (day, brand, category) before the two
    remaining distinct counts, so these expand a small table and not the raw rows.
    """
    daily = latest_by(raw, ["id", "crawl_date"], ["loaded_at"], tie_break)
    groups = daily.groupBy("crawl_date", "brand_name", "category_id").agg(
        F.count("id").alias("products"),
        F.sum(F.col("price").cast("double")).alias("price_sum"),
        F.count("price").alias("priced"),
        F.sum(F.col("discount_rate").cast("double")).alias("rate_sum"),
        F.count("discount_rate").alias("rated"),
        F.sum("quantity_sold").alias("units"),
        _at_least("discount_rate", DEEP_DISCOUNT).alias("deep"),
    )
    return groups.groupBy("crawl_date").agg(
        F.sum("products").alias("total_products"),
        F.count_distinct("brand_name").alias("total_brands"),
        F.count_distinct("category_id").alias("total_categories"),
        F.round(F.try_divide(F.sum("price_sum"), F.sum("priced")), 0).alias("avg_price"),
        F.round(F.try_divide(F.sum("rate_sum"), F.sum("rated")), 1).alias("avg_discount_rate"),
        F.sum("units").alias("total_quantity_sold"),
        F.sum("deep").alias("flash_sale_products"),
    )


def gold_tables(
    products: DataFrame, price_log: DataFrame, raw: DataFrame, unique_ids: bool = True
) -> dict[str, DataFrame]:
    """All five aggregates by name; nothing runs until one is written."""
    return {
        "brand_performance": brand_performance(products, unique_ids),
        "price_trend": price_trend(price_log),
        "discount_analysis": discount_analysis(products, unique_ids),
        "top_products": top_products(products),
        "daily_summary": daily_summary(raw),
    }
