"""Sources and sinks as round trips through the shared folder, and the batch job."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.guards import require_date, require_rows, require_table, require_unique
from lakeops.plans import gold, reports
from lakeops.plans.batch import run_all, run_batch, run_gold
from lakeops.plans.gold_parts import GoldParts
from lakeops.plans.lake import Lake
from lakeops.plans.recovery import recover, recover_range
from lakeops.schema import product_schema
from lakeops.session import scratch_path
from lakeops.sinks import files, tables
from lakeops.sources import catalog
from lakeops.sources import files as sources
from querybook import views
from querybook.book import query
from querybook.gold_queries import ALL_TABLES
from querybook.sql_views import CHANGED


@query(
    "src_ndjson",
    """
    SELECT CASE WHEN good THEN id END AS id, CASE WHEN good THEN name END AS name,
           CASE WHEN good THEN price END AS price, CASE WHEN good THEN brand_name END AS brand_name,
           CASE WHEN good THEN discount_rate END AS discount_rate, good
    FROM (SELECT *, id % 97 <> 0 AS good FROM listing)""",
)
def _(spark, sf):
    path = scratch_path(spark, "ndjson")
    lines = views.listing(spark, sf).select("id", F.to_json(F.struct("*")).alias("value"))
    broken = F.when(F.col("id") % 97 == 0, F.concat(F.lit("{oops "), "value")).otherwise(F.col("value"))
    lines.select(broken.alias("value")).write.text(path)
    rows = sources.read_records(spark, path, corrupt="_bad")
    return rows.select("id", "name", "price", "brand_name", "discount_rate", F.col("_bad").isNull().alias("good"))


def write_arrays(rows, by: str, path: str, shape: str | None = None) -> None:
    """One file with one JSON array per value of (``by``, part): test input of the array sources.

    A part holds 500 ids, so an array stays small however many rows there are.
    """
    arrays = rows.groupBy(by, "part").agg(
        F.array_sort(F.collect_list(F.struct("seq", "record"))).alias("records")
    )
    records = F.transform("records", lambda r: r["record"])
    body = F.concat(F.lit("["), F.array_join(records, ",\n"), F.lit("]\n"))
    texts = arrays.select(by, F.coalesce(F.expr(shape), body).alias("value") if shape else body.alias("value"))
    texts.write.option("maxRecordsPerFile", 1).partitionBy(by).text(path)


@query(
    "backfill_dates",
    """
    SELECT id, name, price,
           CASE WHEN id % 4 = 0 THEN DATE '2023-12-31' ELSE DATE '2024-01-01' + CAST(id % 3 AS INT) END AS crawl_date
    FROM listing""",
)
def _(spark, sf):
    path = scratch_path(spark, "backfill")
    write_arrays(dated_records(spark, sf), "file", path)
    return sources.read_backfill(spark, f"{path}/*").select("id", "name", "price", "crawl_date")


@query(
    "backfill_other_roots",
    """
    SELECT id, CASE WHEN id % 3 = 2 THEN 'broken' ELSE 'read' END AS outcome FROM listing WHERE id % 3 <> 1 AND id % 3 <> 2
    UNION ALL SELECT NULL, 'broken' FROM (SELECT DISTINCT id // 500 FROM listing WHERE id % 3 = 2)""",
)
def _(spark, sf):
    # a third of the files have an object as their root, and a third end too early
    path = scratch_path(spark, "backfill-roots")
    shape = """
        CASE WHEN file LIKE '%02' THEN concat('{"data":[', array_join(transform(records, r -> r.record), ','), ']}')
             WHEN file LIKE '%03' THEN concat('[', array_join(transform(records, r -> r.record), ','), ',{"id":') END"""
    write_arrays(dated_records(spark, sf), "file", path, shape)
    read = sources.read_backfill(spark, f"{path}/*").select("id", F.lit("read").alias("outcome"))
    broken = sources.broken_json_arrays(spark, f"{path}/*", product_schema({"crawl_date": "string"}))
    return read.unionByName(broken.select(F.lit(None).cast("long").alias("id"), F.lit("broken").alias("outcome")))


def dated_records(spark, sf):
    """Parts as records of three dated files; some carry a date of their own."""
    own = F.when(F.col("id") % 4 == 0, "2023-12-31").when(F.col("id") % 4 == 1, "soon")
    record = F.to_json(F.struct("id", "name", "price", own.alias("crawl_date")))
    return views.listing(spark, sf).select(
        F.concat(F.lit("raw_2024-01-0"), F.col("id") % 3 + 1).alias("file"),
        F.floor(F.col("id") / 500).alias("part"),
        F.col("id").alias("seq"),
        record.alias("record"),
    )


@query(
    "load_shards",
    """
    SELECT id, name, price + CASE WHEN id % 5 = 0 THEN 1 WHEN id % 7 = 0 THEN 2 ELSE 0 END AS price,
           brand_name, '' AS thumbnail_url, 0 AS review_count,
           CASE WHEN id % 2 = 0 THEN quantity_sold ELSE 0 END AS quantity_sold, true AS is_active
    FROM listing""",
)
def _(spark, sf):
    path = scratch_path(spark, "shards")
    base = views.listing(spark, sf).withColumns({"shard": F.floor(F.col("id") / 500) * 2, "seq": F.col("id")})
    later = base.filter("id % 5 = 0").withColumns({"shard": F.col("shard") + 1, "price": F.col("price") + 1})
    repeated = base.filter("id % 7 = 0").withColumns({"seq": F.col("seq") + 1000000, "price": F.col("price") + 2})
    units = F.struct(F.col("quantity_sold").alias("value"))
    with_units = F.to_json(F.struct("id", "name", "price", "brand_name", units.alias("quantity_sold")))
    without = F.to_json(F.struct("id", "name", "price", "brand_name"))
    rows = base.unionByName(later).unionByName(repeated)
    rows = rows.select(
        F.format_string("mock_%012d", "shard").alias("file"),
        F.lit(0).alias("part"),
        "seq",
        F.when(F.col("id") % 2 == 0, with_units).otherwise(without).alias("record"),
    )
    write_arrays(rows, "file", path)
    columns = ["id", "name", "price", "brand_name", "thumbnail_url", "review_count", "quantity_sold", "is_active"]
    return sources.load_shards(spark, f"{path}/*").select(columns)


@query(
    "csv_roundtrip",
    """
    SELECT id, name || ', "new"' AS name, price, discount_rate,
           CASE WHEN quantity_sold >= 500 THEN 'Hot' ELSE 'Slow' END AS sales_status,
           DATE '2024-05-01' + CAST(id % 3 AS INT) AS crawl_date
    FROM listing""",
)
def _(spark, sf):
    path = scratch_path(spark, "csv")
    status = F.when(F.col("quantity_sold") >= 500, "Hot").otherwise("Slow")
    dated = F.date_add(F.lit("2024-05-01").cast("date"), (F.col("id") % 3).cast("int"))
    rows = views.listing(spark, sf).select(
        "id", F.concat("name", F.lit(', "new"')).alias("name"), "price", "discount_rate",
        status.alias("sales_status"), dated.alias("crawl_date"),
    )
    files.write_csv(rows, path, by=["crawl_date"])
    back = sources.read_csv(spark, path)
    return back.withColumns({"id": F.col("id").cast("bigint"), "price": F.col("price").cast("bigint")})


@query("parquet_roundtrip", "SELECT id, sku, name, price, brand_name FROM listing")
def _(spark, sf):
    path = scratch_path(spark, "parquet")
    files.write_parquet(views.listing(spark, sf).select("id", "sku", "name", "price", "brand_name"), path)
    return sources.read_parquet(spark, path)


@query(
    "bronze_overwrite",
    """
    SELECT id, crawl_date, CASE WHEN crawl_date = DATE '2001-01-01' THEN price + 1 ELSE price END AS price
    FROM products_daily""",
)
def _(spark, sf):
    path = scratch_path(spark, "bronze")
    files.write_bronze(views.products_daily(spark, sf), path, many_days=True)
    again = views.last_batch(spark, sf).withColumn("price", F.col("price") + 1)
    files.write_bronze(again, path)
    return spark.read.parquet(path).select("id", "crawl_date", "price")


@query(
    "bronze_append",
    """
    SELECT id, crawl_date, 'batch' AS ingest, price FROM batch_2001
    UNION ALL SELECT id, crawl_date, 'stream-1', price + 7 FROM batch_2001""",
)
def _(spark, sf):
    path = scratch_path(spark, "bronze")
    batch = views.last_batch(spark, sf).select("id", "crawl_date", "price")
    moved = batch.withColumn("price", F.col("price") + 7)
    for rows, ingest in ((batch, "batch"), (moved, "stream-1"), (moved, "stream-1"), (batch, "batch")):
        files.write_bronze(rows, path, ingest)
    return spark.read.parquet(path).select("id", "crawl_date", "ingest", "price")


@query("history_append", "SELECT id, crawl_date, price, discount_rate, CAST(crawl_date AS VARCHAR) < '2000' AS early FROM price_history")
def _(spark, sf):
    path = scratch_path(spark, "history")
    log = views.price_history(spark, sf).select("id", "crawl_date", "price", "discount_rate")
    early, late = log.filter("crawl_date < '2000-01-01'"), log.filter("crawl_date >= '2000-01-01'")
    for rows, run in ((early, "early"), (late, "late"), (late, "late")):
        files.append_run(rows, path, run)
    back = spark.read.parquet(path)
    return back.withColumn("early", F.col("run") == "early").drop("run")


@query("create_replace", "SELECT id, name, price, price * 2 AS doubled FROM listing")
def _(spark, sf):
    folder = scratch_path(spark, "replace")
    rows = views.listing(spark, sf).select("id", "name", "price")
    name = f"querybook_{folder.rsplit('-', 1)[-1]}"
    tables.create_or_replace(rows, name, folder)
    tables.create_or_replace(rows.withColumn("doubled", F.col("price") * 2), name, folder)
    replaced = spark.table(name)
    tables.drop_tables(spark, [name], really=True)
    return replaced


@query(
    "gold_dual_sink",
    """
    SELECT crawl_date, category_id, category_name, count(*) AS total_price_changes, min(price) AS min_new_price,
           max(price) AS max_new_price, 2 AS sinks
    FROM price_history GROUP BY ALL""",
)
def _(spark, sf):
    folder = scratch_path(spark, "dual")
    name = f"querybook_{folder.rsplit('-', 1)[-1]}"
    trend = gold.price_trend(views.price_history(spark, sf)).select(
        "crawl_date", "category_id", "category_name", "total_price_changes", "min_new_price", "max_new_price"
    )
    tables.publish(
        trend, [tables.table_sink(name, f"{folder}/table"), lambda df: files.write_parquet(df, f"{folder}/report")]
    )
    both = spark.table(name).unionByName(spark.read.parquet(f"{folder}/report"))
    tables.drop_tables(spark, [name], really=True)
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).cast("int").alias("sinks"))


SNAPSHOTS = """
    SELECT * REPLACE (CASE WHEN year(crawl_date) <= 1996 THEN DATE '1996-01-01'
                           WHEN year(crawl_date) <= 1999 THEN DATE '1999-01-01'
                           ELSE DATE '2001-01-01' END AS crawl_date)
    FROM products_raw"""
BEST = ["price", "original_price", "discount", "discount_rate", "rating_average", "review_count", "quantity_sold"]


@query(
    "batch_load",
    f"""
    WITH snapshots AS (
        SELECT * FROM ({SNAPSHOTS})
        QUALIFY row_number() OVER (PARTITION BY id, crawl_date
                                   ORDER BY {", ".join(c + " DESC NULLS LAST" for c in BEST)}) = 1),
    cover AS (SELECT category_id, max(crawl_date) AS until FROM snapshots GROUP BY category_id)
    SELECT id, trim(brand_name) AS brand_name, price, original_price, discount, discount_rate, quantity_sold,
           category_id, until = crawl_date AS is_active, crawl_date,
           'products_raw_' || strftime(crawl_date, '%Y-%m-%d') || '.json' AS source_file
    FROM snapshots JOIN cover USING (category_id)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC) = 1""",
)
def _(spark, sf):
    lake, paths = dated_files(spark, sf, "batch")
    for path in paths:
        run_batch(spark, path, lake, loaded_at=load_time(path))
    return lake.state(spark).read().select(
        "id", "brand_name", "price", "original_price", "discount", "discount_rate", "quantity_sold",
        "category_id", "is_active", "crawl_date", F.regexp_replace("source_file", "^file=", "").alias("source_file"),
    )


def dated_files(spark, sf, label: str) -> tuple[Lake, list[str]]:
    """A new lake, and line items as three dated files of product records."""
    root = scratch_path(spark, label)
    raw = views.products_raw(spark, sf)
    year = F.year("crawl_date")
    day = F.when(year <= 1996, "1996-01-01").when(year <= 1999, "1999-01-01").otherwise("2001-01-01")
    record = raw.drop("crawl_date", "loaded_at", "source_file", "l_orderkey", "l_linenumber", "l_suppkey")
    name = F.concat(F.lit("products_raw_"), day, F.lit(".json"))
    lines = raw.select(name.alias("file"), F.to_json(F.struct(*record.columns)).alias("value"))
    # as text the records take most of what a job writes; a file stays small enough for one task
    packed = lines.write.option("compression", "lz4").option("maxRecordsPerFile", 1_000_000)
    packed.partitionBy("file").text(f"{root}/in")
    dates = ("1996-01-01", "1999-01-01", "2001-01-01")
    return Lake(f"{root}/lake"), [f"{root}/in/file=products_raw_{date}.json" for date in dates]


def write_corrected(spark, sf, folder: str, date: str) -> str:
    """The file of one snapshot again, with some prices raised and some products missing."""
    raw = views.products_raw(spark, sf)
    year = F.year("crawl_date")
    raw = raw.filter((year > 1996) & (year <= 1999) & (F.col("id") % 7 != 0))
    raw = raw.withColumn("price", F.col("price") + F.when(F.col("id") % 5 == 0, 1).otherwise(0))
    record = raw.drop("crawl_date", "loaded_at", "source_file", "l_orderkey", "l_linenumber", "l_suppkey")
    path = f"{folder}/products_raw_{date}.json"
    files.write_ndjson(record, path, compression="lz4")
    return path


CORRECTED = """
    SELECT * REPLACE (CAST(price + CASE WHEN crawl_date = DATE '1999-01-01' AND id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT)
                      AS price)
    FROM (SELECTED) WHERE crawl_date <> DATE '1999-01-01' OR id % 7 <> 0"""


def live_and_recovered(snapshots: str) -> str:
    """SQL of log and state after all snapshots, the same for a live lake and for its recovery."""
    return f"""
    WITH snapshots AS (
        SELECT * REPLACE (trim(brand_name) AS brand_name) FROM ({snapshots})
        QUALIFY row_number() OVER (PARTITION BY id, crawl_date
                                   ORDER BY {", ".join(c + " DESC NULLS LAST" for c in BEST)}) = 1),
    cover AS (SELECT category_id, max(crawl_date) AS until FROM snapshots GROUP BY category_id),
    both_parts AS (
        SELECT 'state' AS part, id, price, original_price, discount_rate, crawl_date, until = crawl_date AS is_active
        FROM snapshots JOIN cover USING (category_id)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC) = 1
        UNION ALL
        SELECT 'log', id, price, original_price, discount_rate, crawl_date, true FROM snapshots
        WINDOW h AS (PARTITION BY id ORDER BY crawl_date)
        QUALIFY row_number() OVER h = 1 OR {CHANGED})
    SELECT b.*, origin FROM both_parts b, (VALUES ('live'), ('recovered')) o(origin)"""


def parts_of(spark, live: Lake, recovered: Lake):
    """Log and state of two lakes, with their origin."""
    columns = ["id", "price", "original_price", "discount_rate", "crawl_date", "is_active"]
    found = []
    for lake, origin in ((live, "live"), (recovered, "recovered")):
        found.append(lake.state(spark).read().select(F.lit("state").alias("part"), *columns, F.lit(origin).alias("origin")))
        found.append(lake.read_history(spark).select(F.lit("log").alias("part"), *columns, F.lit(origin).alias("origin")))
    return reduce(DataFrame.unionByName, found)


@query("batch_repeat", live_and_recovered(CORRECTED.replace("SELECTED", SNAPSHOTS)))
def _(spark, sf):
    lake, paths = dated_files(spark, sf, "batch-repeat")
    for path in paths:
        run_batch(spark, path, lake, loaded_at=load_time(path))
    again = write_corrected(spark, sf, f"{lake.root}/again", "1999-01-01")
    run_batch(spark, again, lake, loaded_at=datetime(2002, 1, 1))
    recovered = Lake(f"{lake.root}/recovered")
    recover(spark, lake, recovered, skip_gold=True)
    return parts_of(spark, lake, recovered)


@query("batch_out_of_order", live_and_recovered(SNAPSHOTS))
def _(spark, sf):
    lake, paths = dated_files(spark, sf, "batch-order")
    for hour, path in enumerate([paths[2], paths[0], paths[1]]):
        run_batch(spark, path, lake, loaded_at=datetime(2002, 1, 1, hour))
    recovered = Lake(f"{lake.root}/recovered")
    recover(spark, lake, recovered, skip_gold=True)
    return parts_of(spark, lake, recovered)


@query("recover_range", live_and_recovered(CORRECTED.replace("SELECTED", SNAPSHOTS)).replace("'live'", "'range'"))
def _(spark, sf):
    # the raw rows of the middle day are corrected, log and state are not
    lake, paths = dated_files(spark, sf, "recover-range")
    for path in paths:
        run_batch(spark, path, lake, loaded_at=load_time(path))
    again = write_corrected(spark, sf, f"{lake.root}/again", "1999-01-01")
    run_batch(spark, again, lake, layer="bronze", loaded_at=datetime(2002, 1, 1))
    whole, part = Lake(f"{lake.root}/whole"), Lake(f"{lake.root}/part")
    recover(spark, lake, whole, skip_gold=True)
    recover_range(spark, lake, part, "1999-01-01", "1999-01-01", skip_gold=True)
    found = parts_of(spark, part, whole)
    return found.withColumn("origin", F.when(F.col("origin") == "live", "range").otherwise(F.col("origin")))


LOADED = f"""
    WITH snapshots AS (
        SELECT * REPLACE (trim(brand_name) AS brand_name) FROM ({SNAPSHOTS})
        QUALIFY row_number() OVER (PARTITION BY id, crawl_date
                                   ORDER BY {", ".join(c + " DESC NULLS LAST" for c in BEST)}) = 1),
    current AS (SELECT * FROM snapshots
                QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC) = 1)"""


def kept_gold(spark, sf, label: str) -> dict[str, DataFrame]:
    """Aggregates kept through three loads, the last one repeated with other data and then as it was."""
    lake, paths = dated_files(spark, sf, label)
    for path in paths:
        run_batch(spark, path, lake, loaded_at=load_time(path), keep_gold=True)
    again = views.with_part(spark, sf, views.load_rows(spark, sf).filter("id % 3 = 0").withColumn("price", F.col("price") + 9))
    folder = f"{lake.root}/again/products_raw_2001-01-01.json"
    files.write_ndjson(again.select(*product_schema().fieldNames()), folder, compression="lz4")
    for path, hour in ((folder, 1), (paths[2], 2)):
        run_batch(spark, path, lake, loaded_at=datetime(2001, 1, 1, hour), keep_gold=True)
    return GoldParts(spark, lake).tables()


@query(
    "gold_kept_products",
    LOADED
    + """
    SELECT 'brand' AS kind, category_id, category_name, brand_name, count(*) AS products,
           CAST(sum(quantity_sold) AS BIGINT) AS measure, round(avg(price), 0) AS avg_price,
           round(avg(discount_rate), 1) AS avg_rate, round(avg(rating_average), 2) AS other, max(crawl_date) AS last_updated
    FROM current WHERE brand_name NOT IN ('', 'No Brand') AND quantity_sold > 0 GROUP BY ALL
    UNION ALL
    SELECT 'discount', category_id, category_name, brand_name, count(*), max(discount_rate), round(avg(price), 0),
           round(avg(discount_rate), 1), round(avg(original_price), 0), max(crawl_date)
    FROM current WHERE discount_rate > 0 GROUP BY ALL""",
)
def _(spark, sf):
    tables_of = kept_gold(spark, sf, "kept-products")
    group = ["category_id", "category_name", "brand_name"]
    brand = tables_of["brand_performance"].select(
        F.lit("brand").alias("kind"), *group, F.col("total_products").alias("products"),
        F.col("total_quantity_sold").alias("measure"), "avg_price", F.col("avg_discount_rate").alias("avg_rate"),
        F.col("avg_rating").alias("other"), "last_updated",
    )
    discount = tables_of["discount_analysis"].select(
        F.lit("discount").alias("kind"), *group, F.col("product_count").alias("products"),
        F.col("max_discount_rate").cast("bigint").alias("measure"), F.col("avg_current_price").alias("avg_price"),
        F.col("avg_discount_rate").alias("avg_rate"), F.col("avg_original_price").alias("other"), "last_updated",
    )
    return brand.unionByName(discount)


@query(
    "gold_kept_days",
    LOADED
    + f"""
    , logged AS (SELECT * FROM snapshots WINDOW h AS (PARTITION BY id ORDER BY crawl_date)
                 QUALIFY row_number() OVER h = 1 OR {CHANGED})
    SELECT crawl_date, category_id, count(*) AS products, round(avg(price), 0) AS avg_price,
           round(avg(discount_rate), 1) AS avg_rate, min(price) AS lowest, max(price) AS highest
    FROM logged GROUP BY crawl_date, category_id, category_name
    UNION ALL
    SELECT crawl_date, NULL, count(*), round(avg(price), 0), round(avg(discount_rate), 1),
           count(DISTINCT brand_name), CAST(sum(quantity_sold) AS BIGINT)
    FROM snapshots GROUP BY crawl_date""",
)
def _(spark, sf):
    tables_of = kept_gold(spark, sf, "kept-days")
    trend = tables_of["price_trend"].select(
        "crawl_date", "category_id", F.col("total_price_changes").alias("products"), F.col("avg_new_price").alias("avg_price"),
        F.col("avg_new_discount_rate").alias("avg_rate"), F.col("min_new_price").alias("lowest"), F.col("max_new_price").alias("highest"),
    )
    days = tables_of["daily_summary"].select(
        "crawl_date", F.lit(None).cast("int").alias("category_id"), F.col("total_products").alias("products"), "avg_price",
        F.col("avg_discount_rate").alias("avg_rate"), F.col("total_brands").alias("lowest"),
        F.col("total_quantity_sold").alias("highest"),
    )
    return trend.unionByName(days)


def load_time(path: str) -> datetime:
    return datetime.combine(require_date(path), datetime.min.time())


@query(
    "pipeline_batch",
    LOADED
    + """
    SELECT crawl_date, count(*) AS total_products, count(DISTINCT category_id) AS total_categories,
           round(avg(price), 0) AS avg_price, round(avg(discount_rate), 1) AS avg_discount_rate,
           CAST(sum(quantity_sold) AS BIGINT) AS total_quantity_sold
    FROM snapshots GROUP BY crawl_date""",
)
def _(spark, sf):
    lake, paths = dated_files(spark, sf, "pipeline-batch")
    run_all(spark, paths, lake, load_time)
    return spark.table("gold_daily_summary").select(
        "crawl_date", "total_products", "total_categories", "avg_price", "avg_discount_rate", "total_quantity_sold"
    )


@query(
    "pipeline_gold",
    LOADED
    + """
    SELECT category_id, category_name, brand_name, count(*) AS total_products,
           CAST(sum(quantity_sold) AS BIGINT) AS total_quantity_sold, round(avg(rating_average), 2) AS avg_rating,
           round(avg(price), 0) AS avg_price, max(crawl_date) AS last_updated
    FROM current WHERE brand_name NOT IN ('', 'No Brand') AND quantity_sold > 0
    GROUP BY category_id, category_name, brand_name""",
)
def _(spark, sf):
    lake, paths = dated_files(spark, sf, "pipeline-gold")
    for path in paths:
        run_batch(spark, path, lake, loaded_at=load_time(path))
    run_gold(spark, lake)
    return spark.table("gold_brand_performance").select(
        "category_id", "category_name", "brand_name", "total_products", "total_quantity_sold", "avg_rating",
        "avg_price", "last_updated",
    )


@query("ndjson_roundtrip", "SELECT id, sku, name, price, brand_name, category_id, discount_rate, quantity_sold FROM listing")
def _(spark, sf):
    path = scratch_path(spark, "ndjson")
    files.write_ndjson(views.listing(spark, sf), path)
    back = sources.read_records(spark, path)
    return back.select("id", "sku", "name", "price", "brand_name", "category_id", "discount_rate", "quantity_sold")


@query("csv_single_file", "SELECT id, name, price, 1 AS files FROM listing")
def _(spark, sf):
    path = scratch_path(spark, "csv-single")
    files.write_csv(views.listing(spark, sf).select("id", "name", "price"), path, single_file=True)
    back = sources.read_csv(spark, path, "id BIGINT, name STRING, price BIGINT")
    written = back.select(F.count_distinct("_metadata.file_name")).first()[0]
    return back.withColumn("files", F.lit(written))


@query("table_append", "SELECT id, name, price FROM listing UNION ALL SELECT id, name, price + 1 FROM listing WHERE id % 2 = 0")
def _(spark, sf):
    folder = scratch_path(spark, "append")
    name = f"querybook_{folder.rsplit('-', 1)[-1]}"
    rows = views.listing(spark, sf).select("id", "name", "price")
    tables.append_table(rows, name, folder)
    tables.append_table(rows.filter("id % 2 = 0").withColumn("price", F.col("price") + 1), name)
    appended = spark.read.parquet(folder)
    tables.drop_tables(spark, [name], really=True)
    return appended


SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
               "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>"}
TYPE_CASES = " ".join(f"WHEN '{duck}' THEN '{spark}'" for duck, spark in SPARK_TYPES.items())


def registered(spark, sf) -> dict[str, str]:
    """The given tables as temporary views; table name to view name."""
    names = {name: f"querybook_{name}" for name in ALL_TABLES}
    for name, view in names.items():
        views.table(spark, sf, name).createOrReplaceTempView(view)
    return names


@query(
    "catalog_describe",
    " UNION ALL ".join(
        f"SELECT 'querybook_{t}' AS table_name, column_name, CASE column_type {TYPE_CASES} END AS data_type, "
        f"(SELECT count(*) FROM {t}) AS row_count FROM (DESCRIBE {t})"
        for t in ALL_TABLES
    ),
)
def _(spark, sf):
    names = registered(spark, sf)
    counts = reports.table_counts({view: require_table(spark, view) for view in names.values()})
    return catalog.describe(spark, list(names.values())).join(counts, "table_name")


@query(
    "drop_plan",
    """
    SELECT 'querybook_orders' AS table_name, true AS present, count(*) AS row_count FROM orders
    UNION ALL SELECT 'querybook_lineitem', true, count(*) FROM lineitem
    UNION ALL SELECT 'querybook_missing', false, NULL""",
)
def _(spark, sf):
    registered(spark, sf)
    plan = tables.drop_tables(spark, ["querybook_orders", "querybook_lineitem", "querybook_missing"])
    there = [r.table_name for r in plan.filter("present").collect()]
    counts = reports.table_counts({name: spark.table(name) for name in there})
    return plan.join(counts, "table_name", "left")


@query(
    "guards",
    """
    SELECT 'unique part' AS guard, max(n) = 1 AS passed FROM (SELECT count(*) AS n FROM part GROUP BY p_partkey)
    UNION ALL
    SELECT 'unique line', max(n) = 1 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    UNION ALL SELECT 'rows of orders', count(*) > 0 FROM orders
    UNION ALL SELECT 'rows of the future', count(*) > 0 FROM orders WHERE year(o_orderdate) > 2100
    UNION ALL SELECT 'dated file', true UNION ALL SELECT 'undated file', false""",
)
def _(spark, sf):
    orders = views.table(spark, sf, "orders")
    checks = {
        "unique part": lambda: require_unique(views.table(spark, sf, "part"), ["p_partkey"]),
        "unique line": lambda: require_unique(views.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "rows of orders": lambda: require_rows(orders),
        "rows of the future": lambda: require_rows(orders.filter(F.year("o_orderdate") > 2100)),
        "dated file": lambda: require_date("raw_2024-01-01.json"),
        "undated file": lambda: require_date("raw.json"),
    }
    outcome = []
    for name, check in checks.items():
        try:
            check()
            outcome.append((name, True))
        except ValueError:
            outcome.append((name, False))
    return spark.createDataFrame(outcome, "guard STRING, passed BOOLEAN")


def recovered_gold(spark, sf, label: str) -> None:
    """The aggregates that a recovery writes, as tables of the catalogue, over three dated files loaded as raw rows only."""
    lake, paths = dated_files(spark, sf, label)
    for path in paths:
        run_batch(spark, path, lake, layer="bronze", loaded_at=load_time(path))
    recover(spark, lake, Lake(f"{lake.root}/recovered"))


@query(
    "recover_gold_products",
    LOADED
    + """
    SELECT 'brand' AS kind, category_id, category_name, brand_name, count(*) AS products,
           CAST(sum(quantity_sold) AS BIGINT) AS measure, round(avg(price), 0) AS avg_price, max(crawl_date) AS last_updated
    FROM current WHERE brand_name NOT IN ('', 'No Brand') AND quantity_sold > 0 GROUP BY ALL
    UNION ALL
    SELECT 'discount', category_id, category_name, brand_name, count(*), max(discount_rate), round(avg(price), 0), max(crawl_date)
    FROM current WHERE discount_rate > 0 GROUP BY ALL""",
)
def _(spark, sf):
    recovered_gold(spark, sf, "recover-gold-products")
    group = ["category_id", "category_name", "brand_name"]
    brand = spark.table("gold_brand_performance").select(
        F.lit("brand").alias("kind"), *group, F.col("total_products").alias("products"),
        F.col("total_quantity_sold").alias("measure"), "avg_price", "last_updated",
    )
    discount = spark.table("gold_discount_analysis").select(
        F.lit("discount").alias("kind"), *group, F.col("product_count").alias("products"),
        F.col("max_discount_rate").cast("bigint").alias("measure"), F.col("avg_current_price").alias("avg_price"), "last_updated",
    )
    return brand.unionByName(discount)


@query(
    "recover_gold_days",
    LOADED
    + """
    , best AS (
        SELECT id, round(quantity_sold * 0.5 + rating_average * review_count * 0.3 + discount_rate * 2.0, 1) AS score
        FROM current WHERE review_count >= 10 AND rating_average >= 3.5 ORDER BY score DESC, id LIMIT 100)
    SELECT 'day' AS kind, CAST(crawl_date AS VARCHAR) AS name, CAST(count(*) AS DOUBLE) AS measure, round(avg(price), 0) AS other
    FROM snapshots GROUP BY crawl_date
    UNION ALL SELECT 'best', CAST(id AS VARCHAR), score, NULL FROM best""",
)
def _(spark, sf):
    recovered_gold(spark, sf, "recover-gold-days")
    days = spark.table("gold_daily_summary").select(
        F.lit("day").alias("kind"), F.col("crawl_date").cast("string").alias("name"),
        F.col("total_products").cast("double").alias("measure"), F.col("avg_price").alias("other"),
    )
    best = spark.table("gold_top_products").select(
        F.lit("best").alias("kind"), F.col("id").cast("string").alias("name"),
        F.col("popularity_score").alias("measure"), F.lit(None).cast("double").alias("other"),
    )
    return days.unionByName(best)
