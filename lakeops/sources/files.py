"""File sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.dates import last_date_in_path, safe_date
from lakeops.functions.listing import units_sold
from lakeops.operators.latest import latest_by
from lakeops.schema import product_schema
from lakeops.sources.json_arrays import array_elements

# Text defaults of a record loaded from a shard.
SHARD_TEXT_DEFAULTS = ["brand_name", "thumbnail_url", "category_name", "crawl_date"]
SHARD_ZERO_DEFAULTS = ["price", "original_price", "discount", "discount_rate", "rating_average", "review_count"]


def read_records(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None, corrupt: str | None = None
) -> DataFrame:
    """Newline-delimited JSON under a fixed schema, bad fields NULL; folders are read with all below them.

    ``corrupt`` names a text column that receives lines which are not JSON.
    """
    schema = schema or product_schema()
    reader = spark.read.option("recursiveFileLookup", True)
    if corrupt:
        schema = StructType(list(schema.fields)).add(corrupt, "string")
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).json(path)


def read_json_arrays(spark: SparkSession, path: str | list[str], record: StructType) -> DataFrame:
    """Rows (file, position, record) of files that hold one JSON array each; ``file`` is the whole path.

    Files whose root is something else give no rows, and neither do files that end before their
    array does; ``broken_json_arrays`` has the latter. A file is read by as many tasks as it has
    blocks. Positions rise along a file. An element that is no JSON by itself gives no row; a
    field of the wrong type is NULL while the others stay.
    """
    schema = StructType(list(record.fields)).add("_bad", "string")
    parsed = F.from_json("text", schema, {"columnNameOfCorruptRecord": "_bad"}).alias("r")
    rows = array_elements(spark, path).select("file", "position", parsed).select("file", "position", "r.*")
    return rows.filter(~_lost(record)).select("file", "position", F.struct(*record.fieldNames()).alias("record"))


def broken_json_arrays(spark: SparkSession, path: str | list[str], record: StructType) -> DataFrame:
    """Rows (file, text) of array files that are cut off or otherwise no JSON, each read by one task."""
    return _array_elements(spark, path, record).filter(_lost(record)).select("file", F.col("_bad").alias("text"))


def _lost(record: StructType) -> Column:
    """A field of the wrong type also marks its element, which keeps its other fields."""
    return F.col("_bad").isNotNull() & F.coalesce(*(F.col(c).cast("string") for c in record.fieldNames())).isNull()


def _array_elements(spark: SparkSession, path: str | list[str], record: StructType) -> DataFrame:
    file = F.col("_metadata.file_path").alias("file")
    # the text before the first bracket of a file tells what its root is
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place")
    pieces = spark.read.option("lineSep", "[").text(path).select(file, "value", place)
    arrays = pieces.groupBy("file").agg(F.min_by("value", "place").alias("before"))
    arrays = arrays.filter(F.trim(F.translate("before", "\n\r\t", "   ")) == "").select("file")
    schema = StructType(list(record.fields)).add("_bad", "string")
    reader = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad")
    elements = reader.json(path).select("*", file, F.monotonically_increasing_id().alias("position"))
    return elements.join(arrays, "file", "left_semi")


def read_backfill(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of dated array files; a record's own date wins over the file's."""
    record = product_schema({"crawl_date": "string"})
    rows = read_json_arrays(spark, path, record)
    dated = rows.withColumn("file_date", last_date_in_path(F.col("file"))).filter("file_date is not null")
    records = dated.select("file_date", "record.*")
    return records.withColumn(
        "crawl_date", F.coalesce(safe_date(F.col("crawl_date")), F.col("file_date"))
    ).drop("file_date")


def load_shards(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of array shards with defaults, one per id; the last in (file, position) wins."""
    # units arrive as a number or as an object, so that field is read as text
    record = product_schema({"quantity_sold": "string", "crawl_date": "string"})
    rows = read_json_arrays(spark, path, record)
    last = latest_by(rows.withColumn("id", F.col("record.id")), ["id"], ["file", "position"], tie_break=[])
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in SHARD_ZERO_DEFAULTS}
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in SHARD_TEXT_DEFAULTS}
    return last.select("record.*").withColumns(
        {**zero, **blank, "quantity_sold": units_sold(F.col("quantity_sold")), "is_active": F.lit(True)}
    )


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header; types are inferred (one more pass over the files) unless given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))
