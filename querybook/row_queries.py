"""Stamping, cleaning, normalising, nested data, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.listing import listing_flags, normalize_listing, normalize_variant
from lakeops.functions.text import clean_name
from lakeops.operators import clean, nested, paging
from lakeops.operators.latest import first_by, latest_by
from lakeops.sources.messages import decode
from lakeops.sinks.files import to_messages
from querybook import views
from querybook.book import query


@query(
    "stamp_batch",
    """
    SELECT o_orderkey AS id, true AS is_active,
           CASE o_orderkey % 3 WHEN 0 THEN 'raw_' || strftime(o_orderdate, '%Y-%m-%d') || '.json'
                WHEN 1 THEN 'raw_undated.json' ELSE 'raw_2024-02-31.json' END AS source_file,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS crawl_date
    FROM orders""",
)
def _(spark, sf):
    rows = views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"))
    name = (
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("raw_"), F.date_format("at", "yyyy-MM-dd"), F.lit(".json")))
        .when(F.col("id") % 3 == 1, "raw_undated.json")
        .otherwise("raw_2024-02-31.json")
    )
    return clean.stamp_batch(rows, name).select("id", "is_active", "source_file", "crawl_date")


def dirty(spark, sf):
    """Line items with missing keys and numbers and padded names."""
    key, size = F.col("l_partkey"), F.col("p_size")
    item = views.table(spark, sf, "lineitem")
    return item.join(views.table(spark, sf, "part"), key == F.col("p_partkey")).select(
        F.when(key % 50 != 0, key).alias("id"),
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("name"),
        F.concat("p_brand", F.lit("   ")).alias("brand_name"),
        F.when(F.col("l_orderkey") % 11 != 0, F.floor("l_extendedprice").cast("bigint")).alias("price"),
        F.when(size % 7 != 0, size).alias("discount_rate"),
        F.when(F.col("l_linenumber") != 2, (F.col("l_quantity") * 20).cast("int")).alias("quantity_sold"),
    )


DIRTY = """
    SELECT CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END AS id, l_orderkey, l_linenumber,
           p_name, p_brand,
           CASE WHEN l_orderkey % 11 <> 0 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS price,
           CASE WHEN p_size % 7 <> 0 THEN p_size END AS discount_rate,
           CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity * 20 AS INT) END AS quantity_sold
    FROM lineitem JOIN part ON l_partkey = p_partkey"""


@query(
    "clean_silver",
    f"""
    SELECT id, l_orderkey, l_linenumber, p_name AS name, p_brand AS brand_name, coalesce(price, 0) AS price,
           coalesce(discount_rate, 0) AS discount_rate, coalesce(quantity_sold, 0) AS quantity_sold
    FROM ({DIRTY}) WHERE id IS NOT NULL""",
)
def _(spark, sf):
    return clean.clean_records(dirty(spark, sf))


@query(
    "fill_and_label",
    f"""
    SELECT id, l_orderkey, l_linenumber, price, coalesce(discount_rate, 0) AS discount_rate,
           coalesce(quantity_sold, 0) AS quantity_sold,
           CASE WHEN quantity_sold >= 500 THEN 'Hot' ELSE 'Slow' END AS sales_status
    FROM ({DIRTY}) WHERE price > 0""",
)
def _(spark, sf):
    rows = dirty(spark, sf).drop("name", "brand_name")
    return clean.fill_and_label(rows, ["price", "discount_rate", "quantity_sold"])


def texts(spark, sf):
    """Orders as text fields, some of which are no numbers."""
    key = F.col("o_orderkey")
    return views.table(spark, sf, "orders").select(
        F.when(key % 41 == 0, F.concat(key.cast("string"), F.lit("x"))).otherwise(key.cast("string")).alias("id"),
        F.when(key % 17 == 0, "12x").when(key % 19 != 0, F.floor("o_totalprice").cast("bigint").cast("string")).alias("price"),
        F.col("o_orderpriority").alias("title"),
    )


TEXTS = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 41 <> 0 THEN o_orderkey END AS id,
           CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 THEN floor(o_totalprice) END AS price,
           o_orderpriority AS title,
           CASE WHEN o_orderkey % 41 = 0 AND o_orderkey % 17 = 0 THEN 'id,price'
                WHEN o_orderkey % 41 = 0 THEN 'id' WHEN o_orderkey % 17 = 0 THEN 'price' END AS error
    FROM orders"""


@query("coerce_types", f"SELECT id, price, title, error FROM ({TEXTS})")
def _(spark, sf):
    return clean.coerce_types(texts(spark, sf), {"id": "bigint", "price": "double"})


@query(
    "quarantine",
    f"""
    SELECT coalesce(error, 'none') AS error, count(*) AS row_count, count(id) AS id_count,
           count(price) AS price_count
    FROM ({TEXTS}) GROUP BY 1""",
)
def _(spark, sf):
    good, bad = clean.split_errors(clean.coerce_types(texts(spark, sf), {"id": "bigint", "price": "double"}))
    rows = good.withColumn("error", F.lit("none")).unionByName(bad)
    return rows.groupBy("error").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("id").alias("id_count"), F.count("price").alias("price_count")
    )


@query(
    "reprice",
    """
    SELECT id, l_orderkey, l_linenumber, quantity_sold, cut AS price, base - cut AS discount,
           CASE WHEN base > 0 THEN CAST(trunc((base - cut) / base * 100) AS INT) ELSE 0 END AS discount_rate
    FROM (SELECT *, CAST(trunc(CAST(price AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(0.07 AS DOUBLE))) AS BIGINT) AS cut,
                 coalesce(original_price, price) AS base
          FROM products_raw)""",
)
def _(spark, sf):
    raw = views.load_rows(spark, sf)
    columns = ["id", "l_orderkey", "l_linenumber", "quantity_sold", "price", "discount", "discount_rate"]
    return clean.reprice(raw, 0.07).select(columns)


def listing_json(spark, sf):
    """Parts as raw listing objects in the shapes listings come in."""
    key, size = F.col("p_partkey"), F.col("p_size")
    price = F.floor("p_retailprice").cast("bigint")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    sold = (
        F.when(key % 3 == 0, text(',"quantity_sold":{"text":"sold ', size, '","value":', size, "}"))
        .when(key % 3 == 1, text(',"quantity_sold":', size))
        .otherwise("")
    )
    prices = F.when(
        key % 5 == 0, text(',"price":', price, ',"original_price":0,"list_price":', price + 7)
    ).otherwise(text(',"price":"', price, '","original_price":', price + 9))
    brand = F.when(key % 7 == 0, ',"brand_name":""').otherwise(text(',"brand_name":"', F.col("p_brand"), '"'))
    info = F.when(
        key % 4 == 0, text(',"visible_impression_info":{"amplitude":{"category_l2_name":"', F.col("p_type"), '"}}')
    ).otherwise("")
    flags = (
        F.when(key % 4 == 1, text(',"impression_info":[{"metadata":{"is_ad":', size % 2, ',"is_fast":true}},{"metadata":{"is_ad":9}}]'))
        .when(key % 4 == 2, ',"impression_info":[]')
        .otherwise("")
    )
    body = text('{"id":', key, ',"name":"', F.col("p_name"), ', a\\nb","discount_rate":"', size, '","rating_average":4.5',
                prices, brand, sold, info, flags, "}")
    return views.table(spark, sf, "part").select(body.alias("value"), size.alias("category"))


NORMALIZED = """
    SELECT p_partkey AS id, CAST(NULL AS VARCHAR) AS sku, p_name || ', a' || chr(10) || 'b' AS name,
           CAST(NULL AS VARCHAR) AS url_key, CAST(floor(p_retailprice) AS BIGINT) AS price,
           CAST(floor(p_retailprice) AS BIGINT) + CASE WHEN p_partkey % 5 = 0 THEN 7 ELSE 9 END AS original_price,
           CAST(0 AS BIGINT) AS discount, p_size AS discount_rate,
           CASE WHEN p_partkey % 7 = 0 THEN 'No Brand' ELSE p_brand END AS brand_name,
           CAST(4.5 AS DOUBLE) AS rating_average, 0 AS review_count, '' AS thumbnail_url,
           p_size AS category_id, CASE WHEN p_partkey % 3 = 2 THEN 0 ELSE p_size END AS quantity_sold,
           CASE WHEN p_partkey % 4 = 0 THEN p_type ELSE 'Unknown' END AS sub_category,
           CASE WHEN p_partkey % 3 = 0 THEN 'sold ' || p_size ELSE 'Đã bán 0' END AS sold_text
    FROM part"""


@query("normalize_listing", NORMALIZED)
def _(spark, sf):
    return normalize_listing(listing_json(spark, sf), category="category")


@query("normalize_variant", NORMALIZED)
def _(spark, sf):
    return normalize_variant(listing_json(spark, sf), category="category")


@query(
    "listing_flags",
    """
    SELECT p_partkey AS id, '' AS sku, p_name || ' - a b' AS name,
           CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_brand END AS brand_name,
           floor(p_retailprice) AS price,
           CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE floor(p_retailprice) + 9 END AS original_price,
           p_size AS discount_rate, CAST(4.5 AS DOUBLE) AS rating_average, 0 AS review_count,
           CASE WHEN p_partkey % 3 = 2 THEN 0 ELSE p_size END AS quantity_sold, '' AS thumbnail_url,
           CASE WHEN p_partkey % 4 = 1 THEN p_size % 2 ELSE 0 END AS is_ad,
           CASE WHEN p_partkey % 4 = 1 THEN 1 ELSE 0 END AS is_fast, 0 AS verified
    FROM part""",
)
def _(spark, sf):
    return listing_flags(listing_json(spark, sf), ["is_ad", "is_fast", "verified"])


@query(
    "clean_names",
    """
    SELECT p_partkey AS id, p_name || ' - ' || p_brand || ' ' || p_type AS name,
           p_name || ' "' || p_brand || '"' || chr(10) || chr(13) || chr(39) || p_type AS short_name
    FROM part""",
)
def _(spark, sf):
    rows = views.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat("p_name", F.lit(',"'), "p_brand", F.lit("\"\n\r'"), "p_type").alias("raw"),
    )
    return rows.select(
        "id",
        clean_name(F.col("raw"), comma=" - ").alias("name"),
        clean_name(F.col("raw"), comma=" ", newline=None, drop="").alias("short_name"),
    )


@query(
    "partition_day",
    """
    SELECT id, l_orderkey, l_linenumber, price, quantity_sold, crawl_date
    FROM products_raw WHERE year(crawl_date) = 2000""",
)
def _(spark, sf):
    rows = clean.partition_day(views.load_rows(spark, sf), views.OLD)
    return rows.select("id", "l_orderkey", "l_linenumber", "price", "quantity_sold", "crawl_date")


@query("list_dates", "SELECT DISTINCT strftime(l_shipdate, '%Y-01-01') AS d FROM lineitem")
def _(spark, sf):
    return clean.list_dates(views.load_rows(spark, sf))


@query(
    "date_range",
    """
    SELECT crawl_date, bound, count(*) AS row_count FROM (
        SELECT crawl_date, 'both' AS bound FROM products_raw WHERE year(crawl_date) BETWEEN 1997 AND 1999
        UNION ALL SELECT crawl_date, 'from' FROM products_raw WHERE year(crawl_date) >= 1997
        UNION ALL SELECT crawl_date, 'to' FROM products_raw WHERE year(crawl_date) <= 1999
        UNION ALL SELECT crawl_date, 'open' FROM products_raw)
    GROUP BY crawl_date, bound""",
)
def _(spark, sf):
    ranges = {"both": ("1997-01-01", "1999-12-31"), "from": ("1997-01-01", None), "to": (None, "1999-12-31"), "open": (None, None)}
    inside = F.array_compact(F.array(*(F.when(clean.in_range(*ends), name) for name, ends in ranges.items())))
    tagged = views.load_rows(spark, sf).select("crawl_date", F.explode(inside).alias("bound"))
    return tagged.groupBy("crawl_date", "bound").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "dedup_by_key",
    """
    SELECT id, price, crawl_date, quantity_sold FROM (
        SELECT CASE WHEN id % 50 <> 0 THEN id END AS id, * EXCLUDE (id) FROM products_raw)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC, price DESC, quantity_sold DESC) = 1""",
)
def _(spark, sf):
    rows = views.load_rows(spark, sf).select(
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("id"), "price", "crawl_date", "quantity_sold"
    )
    return latest_by(rows, ["id"], ["crawl_date"])


@query(
    "dedup_first",
    """
    SELECT id, price, crawl_date, quantity_sold FROM products_raw
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date, price, quantity_sold) = 1""",
)
def _(spark, sf):
    rows = views.load_rows(spark, sf).select("id", "price", "crawl_date", "quantity_sold")
    return first_by(rows, ["id"], ["crawl_date"])


@query(
    "page_of",
    "SELECT id, name, price, category_id FROM listing WHERE category_name = 'LARGE' ORDER BY price DESC, id LIMIT 10 OFFSET 10",
)
def _(spark, sf):
    rows = views.listing(spark, sf).filter("category_name = 'LARGE'").select("id", "name", "price", "category_id")
    return paging.page_of(rows, [F.col("price").desc(), F.col("id")], page=2, limit=10)


@query(
    "page_deep",
    """
    WITH placed AS (
        SELECT id, price, l_orderkey, l_linenumber, count(*) OVER () AS n,
               row_number() OVER (ORDER BY price DESC, id, l_orderkey DESC, l_linenumber, l_suppkey, quantity_sold) AS place
        FROM products_raw)
    SELECT id, price, l_orderkey, l_linenumber FROM placed
    WHERE place > n * 9 // 10 // 40 * 40 AND place <= n * 9 // 10 // 40 * 40 + 40""",
)
def _(spark, sf):
    rows = views.load_rows(spark, sf)
    page = rows.count() * 9 // 10 // 40 + 1
    order = ["-price", "id", "-l_orderkey", "l_linenumber", "l_suppkey", "quantity_sold"]
    return paging.deep_page(rows, order, page).select("id", "price", "l_orderkey", "l_linenumber")


@query(
    "page_summary",
    """
    SELECT 2 AS current_page, CAST(ceil(count(*) / 10) AS BIGINT) AS last_page, 10 AS per_page, count(*) AS total
    FROM listing WHERE category_name = 'LARGE'""",
)
def _(spark, sf):
    return paging.page_summary(views.listing(spark, sf).filter("category_name = 'LARGE'"), page=2, limit=10)


@query(
    "to_messages",
    """
    SELECT CAST(id AS VARCHAR) AS key,
           '{"event_id":' || event_id || ',"id":' || id || ',"name":"' || name || '","price":' || price ||
           CASE WHEN discount IS NULL THEN '' ELSE ',"discount":' || discount END ||
           ',"_event_type":"' || _event_type || '","crawl_date":"2024-02-01"}' AS value
    FROM stream_events""",
)
def _(spark, sf):
    events = views.stream_events(spark, sf).select("event_id", "id", "name", "price", "discount", "_event_type")
    return to_messages(events, crawl_date="2024-02-01")


@query(
    "json_decode",
    """
    SELECT CASE WHEN good THEN id END AS id, CASE WHEN good AND event_id % 7 <> 0 THEN price END AS price,
           CASE WHEN good THEN discount END AS discount, CASE WHEN good THEN is_active END AS is_active,
           CASE WHEN good THEN quantity_sold END AS quantity_sold,
           CASE WHEN good THEN strftime(crawl_date, '%Y-%m-%d') END AS crawl_date,
           CASE WHEN good THEN _event_type END AS _event_type, good
    FROM (SELECT *, event_id % 101 <> 0 AS good FROM stream_events)""",
)
def _(spark, sf):
    events = views.stream_events(spark, sf)
    messages = to_messages(events)
    broken = F.get_json_object("value", "$.event_id").cast("bigint") % 101 == 0
    # valid JSON with a price that is no whole number, and counters as objects
    number = F.get_json_object("value", "$.event_id").cast("bigint")
    odd = F.regexp_replace("value", '"price":([0-9]+)', '"price":$1.5')
    counted = F.regexp_replace("value", '"quantity_sold":([0-9]+)', '"quantity_sold":{"value":$1,"text":"sold"}')
    value = F.when(broken, F.concat(F.lit("{oops "), "value")).when(number % 7 == 0, odd).when(number % 2 == 0, counted)
    decoded = decode(messages.withColumn("value", F.coalesce(value, "value")), error="_error")
    return decoded.select(
        "id", "price", "discount", "is_active", "quantity_sold", "crawl_date", "_event_type",
        F.col("_error").isNull().alias("good"),
    )


@query(
    "nested_flatten",
    """
    SELECT id, product_name, seller.name AS shop_name, seller.is_official AS official_shop FROM nested_products""",
)
def _(spark, sf):
    fields = {"id": "id", "product_name": "product_name", "shop_name": "seller.name", "official_shop": "seller.is_official"}
    return nested.flatten(views.nested_products(spark, sf), fields)


@query("nested_explode", "SELECT id, product_name, unnest(badges) AS badge FROM nested_products")
def _(spark, sf):
    rows = views.nested_products(spark, sf).select("id", "product_name", "badges")
    return nested.explode_items(rows, "badges", "badge")


@query(
    "nested_explode_outer",
    """
    SELECT id, product_name,
           unnest(CASE WHEN len(badges) = 0 THEN [CAST(NULL AS VARCHAR)] ELSE badges END) AS badge
    FROM nested_products""",
)
def _(spark, sf):
    rows = views.nested_products(spark, sf).select("id", "product_name", "badges")
    return nested.explode_items(rows, "badges", "badge", keep_empty=True)


@query(
    "nested_two_step",
    """
    SELECT id, product_name, c.id AS cate_id, c.name AS cate_name
    FROM (SELECT id, product_name, unnest(CASE WHEN len(categories) = 0 THEN [NULL] ELSE categories END) AS c
          FROM nested_products)""",
)
def _(spark, sf):
    rows = views.nested_products(spark, sf).select("id", "product_name", "categories")
    return nested.explode_structs(rows, "categories", {"cate_id": "id", "cate_name": "name"})


@query(
    "nested_join_text",
    """
    SELECT id, product_name, CASE WHEN len(badges) = 0 THEN 'none' ELSE array_to_string(badges, ', ') END AS badge_list
    FROM nested_products""",
)
def _(spark, sf):
    rows = views.nested_products(spark, sf).select("id", "product_name", "badges")
    return nested.join_items(rows, "badges", "badge_list", if_empty="none")


@query(
    "attrs_to_columns",
    """
    SELECT p_partkey AS id, p_brand AS brand, CASE WHEN p_size % 4 = 0 THEN 'N/A' ELSE p_type END AS resolution,
           CASE WHEN p_size % 3 = 0 THEN 'rate ' || p_size WHEN p_size % 2 = 0 THEN 'time ' || p_size
                ELSE 'N/A' END AS refresh_rate
    FROM part""",
)
def _(spark, sf):
    size = F.col("p_size")

    def attribute(code, value):
        return F.struct(F.lit(code).alias("code"), value.alias("value"))

    attributes = views.present(
        attribute("brand", F.lit("overwritten")),
        attribute("brand", F.col("p_brand")),
        F.when(size % 4 != 0, attribute("resolution", F.col("p_type"))),
        F.when(size % 2 == 0, attribute("response_time", F.concat(F.lit("time "), size))),
        F.when(size % 3 == 0, attribute("refresh_rate", F.concat(F.lit("rate "), size))),
    )
    rows = views.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), attributes.alias("attributes"))
    wanted = {"brand": ["brand"], "resolution": ["resolution"], "refresh_rate": ["response_time", "refresh_rate"]}
    return nested.attributes_to_columns(rows, "attributes", wanted)
