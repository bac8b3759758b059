"""Record layouts."""

from __future__ import annotations

from pyspark.sql.types import StructType

Fields = dict[str, str]

# Names and types of the product record, of the columns added when
# a batch is loaded, and of the two extra fields a stream event carries.
PRODUCT_FIELDS: Fields = {
    "id": "long",
    "sku": "string",
    "name": "string",
    "url_key": "string",
    "price": "long",
    "original_price": "long",
    "discount": "long",
    "discount_rate": "integer",
    "brand_name": "string",
    "rating_average": "double",
    "review_count": "integer",
    "thumbnail_url": "string",
    "category_id": "integer",
    "category_name": "string",
    "quantity_sold": "integer",
    "is_active": "boolean",
}
LOAD_FIELDS: Fields = {"source_file": "string", "loaded_at": "timestamp", "crawl_date": "date"}
EVENT_FIELDS: Fields = {"crawl_date": "string", "_event_type": "string"}

# The columns whose change makes a new row in the price log.
TRACKED_PRICES = ["price", "original_price", "discount", "discount_rate"]

# The narrow projection kept by the speed layer.
SPEED_COLUMNS = ["id", "name", "price", "discount_rate", "quantity_sold", "loaded_at", "_event_type"]


def struct_of(fields: Fields) -> StructType:
    schema = StructType()
    for name, data_type in fields.items():
        schema.add(name, data_type)
    return schema


def product_schema(extra: Fields | None = None) -> StructType:
    """The flat product record, optionally followed by more fields."""
    return struct_of({**PRODUCT_FIELDS, **(extra or {})})


def stored_schema() -> StructType:
    """A product record as stored: the record and its load columns."""
    return product_schema(LOAD_FIELDS)


def event_schema(extra: Fields | None = None) -> StructType:
    """A stream event: the record, a text date, the event type, and optional ordering fields."""
    return product_schema({**EVENT_FIELDS, **(extra or {})})
