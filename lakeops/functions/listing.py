"""Raw listing objects (JSON text) to flat product columns.

The object is parsed once per row. Fields that arrive in several shapes are read
as text, which keeps numbers, quoted numbers and nested objects apart from NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import NO_BRAND, clean_name

# The fields of a raw listing object that are read.
LISTING_FIELDS = """
    id STRING, sku STRING, name STRING, url_key STRING, price STRING,
    original_price STRING, list_price STRING, discount STRING, discount_rate STRING,
    brand_name STRING, rating_average STRING, review_count STRING,
    thumbnail_url STRING, quantity_sold STRING,
    visible_impression_info STRUCT<amplitude: STRUCT<category_l2_name: STRING>>
"""
# Texts that stand in for missing nested fields.
UNKNOWN_CATEGORY = "Unknown"
NONE_SOLD_TEXT = "Đã bán 0"
UNKNOWN_BRAND = "Unknown"


def number(text: Column, as_type: str, default: int = 0) -> Column:
    """Text as a number; the default when absent or not numeric."""
    return F.coalesce(text.try_cast(as_type), F.lit(default).cast(as_type))


def units_sold(raw: Column) -> Column:
    """The counter inside ``{"value": n}``, or a bare number, or 0."""
    return F.coalesce(
        F.get_json_object(raw, "$.value").try_cast("int"),
        raw.try_cast("double").try_cast("int"),
        F.lit(0),
    )


def filled(text: Column, default: str) -> Column:
    """The default for NULL and for empty text."""
    return F.when(text.isNull() | (text == ""), default).otherwise(text)


def flag(text: Column) -> Column:
    """0 or 1 from a number or a boolean in text form."""
    return F.coalesce(text.try_cast("int"), text.try_cast("boolean").cast("int"), F.lit(0))


def parse_listing(df: DataFrame, json_column: str, keep: list[str], extra_fields: str = "") -> DataFrame:
    """The ``keep`` columns and the parsed object as struct column ``item``."""
    parsed = F.from_json(F.col(json_column), LISTING_FIELDS + extra_fields).alias("item")
    return df.select(*keep, parsed)


def normalize_listing(
    df: DataFrame, json_column: str = "value", keep: list[str] | None = None, category: str | None = None
) -> DataFrame:
    """Product columns with defaults, plus the second-level category and the sold text.

    ``category`` names the column with the category that the listing was asked for.
    """
    asked = F.lit(None) if category is None else F.col(category)
    carried = [*(keep or []), *([category] if category else [])]
    item = F.col("item")
    original = item.original_price.try_cast("bigint")
    list_price = number(item.list_price, "bigint")
    sold_text = F.get_json_object(item.quantity_sold, "$.text")
    level2 = item.visible_impression_info.amplitude.category_l2_name
    return parse_listing(df, json_column, carried).select(
        *(keep or []),
        asked.cast("int").alias("category_id"),
        item.id.try_cast("bigint").alias("id"),
        item.sku.alias("sku"),
        item["name"].alias("name"),
        item.url_key.alias("url_key"),
        number(item.price, "bigint").alias("price"),
        F.when(original != 0, original).otherwise(list_price).alias("original_price"),
        number(item.discount, "bigint").alias("discount"),
        number(item.discount_rate, "int").alias("discount_rate"),
        filled(item.brand_name, NO_BRAND).alias("brand_name"),
        number(item.rating_average, "double").alias("rating_average"),
        number(item.review_count, "int").alias("review_count"),
        F.coalesce(item.thumbnail_url, F.lit("")).alias("thumbnail_url"),
        units_sold(item.quantity_sold).alias("quantity_sold"),
        F.coalesce(level2, F.lit(UNKNOWN_CATEGORY)).alias("sub_category"),
        F.coalesce(sold_text, F.lit(NONE_SOLD_TEXT)).alias("sold_text"),
    )


def normalize_variant(
    df: DataFrame, json_column: str = "value", keep: list[str] | None = None, category: str | None = None
) -> DataFrame:
    """As ``normalize_listing``, over one binary form of the object that is read by typed paths.

    A field that comes as a number, a text or an object is then not parsed from text again. A
    number with a fraction is cut where a whole one is asked for, and not taken as missing.
    """
    asked = F.lit(None) if category is None else F.col(category)
    carried = [*(keep or []), *([category] if category else [])]
    parsed = df.select(*carried, F.try_parse_json(F.col(json_column)).alias("item"))

    def at(path: str, as_type: str) -> Column:
        return F.try_variant_get("item", f"$.{path}", as_type)

    def whole(path: str, as_type: str = "bigint") -> Column:
        return F.coalesce(at(path, as_type), F.lit(0).cast(as_type))

    original = at("original_price", "bigint")
    return parsed.select(
        *(keep or []),
        asked.cast("int").alias("category_id"),
        at("id", "bigint").alias("id"),
        *(at(c, "string").alias(c) for c in ("sku", "name", "url_key")),
        whole("price").alias("price"),
        F.when(original != 0, original).otherwise(whole("list_price")).alias("original_price"),
        whole("discount").alias("discount"),
        whole("discount_rate", "int").alias("discount_rate"),
        filled(at("brand_name", "string"), NO_BRAND).alias("brand_name"),
        whole("rating_average", "double").alias("rating_average"),
        whole("review_count", "int").alias("review_count"),
        F.coalesce(at("thumbnail_url", "string"), F.lit("")).alias("thumbnail_url"),
        F.coalesce(at("quantity_sold.value", "int"), at("quantity_sold", "int"), F.lit(0)).alias("quantity_sold"),
        F.coalesce(
            at("visible_impression_info.amplitude.category_l2_name", "string"), F.lit(UNKNOWN_CATEGORY)
        ).alias("sub_category"),
        F.coalesce(at("quantity_sold.text", "string"), F.lit(NONE_SOLD_TEXT)).alias("sold_text"),
    )


def listing_flags(df: DataFrame, flags: list[str], json_column: str = "value") -> DataFrame:
    """The typed listing row with the named flags, 0 or 1, from the metadata of its first impression entry."""
    item = F.col("item")
    fields = ", ".join(f"`{name}`: STRING" for name in flags)
    impressions = f", impression_info ARRAY<STRUCT<metadata: STRUCT<{fields}>>>"
    first = F.try_element_at(item.impression_info, F.lit(1)).metadata
    return parse_listing(df, json_column, [], impressions).select(
        item.id.try_cast("bigint").alias("id"),
        F.coalesce(item.sku, F.lit("")).alias("sku"),
        clean_name(F.coalesce(item["name"], F.lit("")), drop="").alias("name"),
        F.coalesce(item.brand_name, F.lit(UNKNOWN_BRAND)).alias("brand_name"),
        number(item.price, "double").alias("price"),
        number(item.original_price, "double").alias("original_price"),
        number(item.discount_rate, "int").alias("discount_rate"),
        number(item.rating_average, "double").alias("rating_average"),
        number(item.review_count, "int").alias("review_count"),
        units_sold(item.quantity_sold).alias("quantity_sold"),
        F.coalesce(item.thumbnail_url, F.lit("")).alias("thumbnail_url"),
        *[flag(first[name]).alias(name) for name in flags],
    )
