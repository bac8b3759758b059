"""Aggregates and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.text import FIRST_SEEN, PRICE_DOWN, PRICE_SAME, PRICE_UP
from lakeops.operators.history import change_log, replay_state
from lakeops.plans import gold, reports
from lakeops.session import staged
from querybook import views
from querybook.book import query


@query(
    "gold_brand_performance",
    """
    SELECT category_id, category_name, brand_name,
           count(*) AS total_products, CAST(sum(quantity_sold) AS BIGINT) AS total_quantity_sold,
           round(avg(rating_average), 2) AS avg_rating, round(avg(review_count), 0) AS avg_reviews,
           round(avg(price), 0) AS avg_price, round(avg(discount_rate), 1) AS avg_discount_rate,
           max(crawl_date) AS last_updated
    FROM products
    WHERE trim(brand_name) NOT IN ('', 'No Brand') AND quantity_sold > 0
    GROUP BY ALL""",
)
def _(spark, sf):
    return gold.brand_performance(views.products(spark, sf), unique_ids=True)


@query(
    "gold_price_trend",
    """
    SELECT crawl_date, category_id, category_name, count(*) AS total_price_changes,
           round(avg(price), 0) AS avg_new_price, min(price) AS min_new_price, max(price) AS max_new_price,
           round(avg(discount_rate), 1) AS avg_new_discount_rate
    FROM price_history GROUP BY ALL""",
)
def _(spark, sf):
    return gold.price_trend(views.price_history(spark, sf))


@query(
    "gold_discount_analysis",
    """
    SELECT category_id, category_name, brand_name, count(*) AS product_count,
           round(avg(discount_rate), 1) AS avg_discount_rate, max(discount_rate) AS max_discount_rate,
           count(*) FILTER (discount_rate >= 30) AS products_30pct_off,
           count(*) FILTER (discount_rate >= 50) AS products_50pct_off,
           round(avg(price), 0) AS avg_current_price, round(avg(original_price), 0) AS avg_original_price,
           max(crawl_date) AS last_updated
    FROM products WHERE discount_rate > 0 GROUP BY ALL""",
)
def _(spark, sf):
    return gold.discount_analysis(views.products(spark, sf), unique_ids=True)


@query(
    "gold_top_products",
    """
    SELECT id, name, brand_name, category_id, category_name, round(price / 1000, 1) AS price_k,
           round(original_price / 1000, 1) AS original_price_k, discount_rate, rating_average, review_count,
           quantity_sold, url_key, thumbnail_url, crawl_date AS last_updated,
           round(quantity_sold * 0.5 + rating_average * review_count * 0.3 + discount_rate * 2.0, 1)
               AS popularity_score
    FROM products WHERE review_count >= 10 AND rating_average >= 3.5
    ORDER BY popularity_score DESC, id LIMIT 100""",
)
def _(spark, sf):
    return gold.top_products(views.products(spark, sf))


@query(
    "gold_daily_summary",
    """
    SELECT crawl_date, count(DISTINCT id) AS total_products, count(DISTINCT brand_name) AS total_brands,
           count(DISTINCT category_id) AS total_categories, round(avg(price), 0) AS avg_price,
           round(avg(discount_rate), 1) AS avg_discount_rate,
           CAST(sum(quantity_sold) AS BIGINT) AS total_quantity_sold,
           count(*) FILTER (discount_rate >= 50) AS flash_sale_products
    FROM products_daily GROUP BY crawl_date""",
)
def _(spark, sf):
    return gold.daily_summary(views.products_raw(spark, sf), views.TIE)


@query(
    "report_changes_per_day",
    "SELECT crawl_date, count(*) AS changed_products FROM price_history GROUP BY crawl_date",
)
def _(spark, sf):
    return reports.changes_per_day(views.price_history(spark, sf))


@query(
    "report_flash_sale_day",
    """
    SELECT count(*) FILTER (discount_rate >= 50) AS flash_sale_products
    FROM products_raw WHERE crawl_date = DATE '2000-01-01'""",
)
def _(spark, sf):
    return reports.flash_sale_on(views.load_rows(spark, sf), views.OLD)


@query(
    "report_brand_top10",
    """
    SELECT brand_name, count(*) AS product_count, round(avg(price), 0) AS avg_price,
           round(avg(discount_rate), 2) AS avg_discount_rate, round(avg(rating_average), 1) AS avg_rating
    FROM products GROUP BY brand_name ORDER BY product_count DESC, brand_name NULLS FIRST LIMIT 10""",
)
def _(spark, sf):
    return reports.top_brands(views.products(spark, sf))


@query(
    "report_brand_top5",
    """
    SELECT brand_name, count(*) AS product_count FROM products
    GROUP BY brand_name ORDER BY product_count DESC, brand_name NULLS FIRST LIMIT 5""",
)
def _(spark, sf):
    return reports.top_brands(views.products(spark, sf), 5, details=False)


@query(
    "report_daily_changes",
    """
    SELECT crawl_date, count(*) FILTER (part = 'seen') AS total_products,
           count(*) FILTER (part = 'first') AS new_products,
           count(*) FILTER (part = 'logged') - count(*) FILTER (part = 'first') AS changed_products,
           count(*) FILTER (part = 'seen') - count(*) FILTER (part = 'logged') AS unchanged_products
    FROM (SELECT DISTINCT crawl_date, id, 'seen' AS part FROM products_raw
          UNION ALL SELECT crawl_date, id, 'logged' FROM price_history
          UNION ALL SELECT min(crawl_date), id, 'first' FROM price_history GROUP BY id)
    GROUP BY crawl_date""",
)
def _(spark, sf):
    return reports.daily_changes(views.price_history(spark, sf), views.load_rows(spark, sf))


@query(
    "report_price_moves",
    f"""
    SELECT id, name, crawl_date, price AS current_price, lag(price) OVER h AS previous_price,
           price - lag(price) OVER h AS price_diff,
           CASE sign(price - lag(price) OVER h)
                WHEN 1 THEN '{PRICE_UP}' WHEN -1 THEN '{PRICE_DOWN}' WHEN 0 THEN '{PRICE_SAME}'
                ELSE '{FIRST_SEEN}' END AS price_trend
    FROM price_history WINDOW h AS (PARTITION BY id ORDER BY crawl_date)""",
)
def _(spark, sf):
    return reports.price_moves(views.price_history(spark, sf))


@query(
    "report_price_moves_chunked",
    f"""
    SELECT id, name, crawl_date, price AS current_price, lag(price) OVER h AS previous_price,
           price - lag(price) OVER h AS price_diff,
           CASE sign(price - lag(price) OVER h)
                WHEN 1 THEN '{PRICE_UP}' WHEN -1 THEN '{PRICE_DOWN}' WHEN 0 THEN '{PRICE_SAME}'
                ELSE '{FIRST_SEEN}' END AS price_trend
    FROM (SELECT * REPLACE (CASE WHEN id % 5 <> 0 THEN id END AS id) FROM stream_events)
    WINDOW h AS (PARTITION BY id ORDER BY event_id)""",
)
def _(spark, sf):
    # a log with many rows per key, a fifth of them without a key; event ids rise with time
    events = views.stream_events(spark, sf).withColumn("id", F.when(F.col("id") % 5 != 0, F.col("id")))
    events = events.withColumn("crawl_date", F.col("crawl_date").cast("date"))
    return reports.price_moves(events, order=["event_id"], chunk=F.floor(F.col("event_id") / 1000))


@query(
    "report_daily_sales",
    """
    SELECT id, name, crawl_date, quantity_sold AS lifetime_sales,
           lag(quantity_sold) OVER h AS yesterday_lifetime_sales,
           coalesce(quantity_sold - lag(quantity_sold) OVER h, 0) AS sales_today
    FROM products_daily WINDOW h AS (PARTITION BY id ORDER BY crawl_date)""",
)
def _(spark, sf):
    return reports.daily_sales(views.products_raw(spark, sf), views.TIE)


@query(
    "latest_per_day",
    """
    SELECT id, crawl_date, CAST(loaded_at AS DATE) AS loaded_on, name, price, original_price, discount,
           discount_rate, quantity_sold, rating_average
    FROM products_daily""",
)
def _(spark, sf):
    return views.products_daily(spark, sf).select(
        "id", "crawl_date", F.col("loaded_at").cast("date").alias("loaded_on"), "name", "price",
        "original_price", "discount", "discount_rate", "quantity_sold", "rating_average",
    )


@query(
    "events_by_type",
    "SELECT upper(event_type) AS _event_type, count(*) AS event_count FROM events GROUP BY event_type",
)
def _(spark, sf):
    return reports.events_by_type(views.stream_events(spark, sf))


@query(
    "metric_topn",
    """
    SELECT brand_name, CAST(sum(quantity_sold) AS BIGINT) AS units_sold FROM products
    WHERE trim(brand_name) NOT IN ('', 'No Brand') AND quantity_sold > 0
    GROUP BY brand_name ORDER BY units_sold DESC, brand_name LIMIT 10""",
)
def _(spark, sf):
    leaders = gold.brand_performance(views.products(spark, sf), unique_ids=True)
    return reports.metric_by(leaders, "brand_name", F.sum("total_quantity_sold"), "units_sold")


ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES),
)
def _(spark, sf):
    return reports.table_counts({name: views.table(spark, sf, name) for name in ALL_TABLES})


@query(
    "gold_all",
    """
    SELECT 'brand_performance' AS table_name, count(DISTINCT (category_id, category_name, brand_name)) AS row_count
    FROM products WHERE trim(brand_name) NOT IN ('', 'No Brand') AND quantity_sold > 0
    UNION ALL
    SELECT 'price_trend', count(DISTINCT (crawl_date, category_id, category_name)) FROM price_history
    UNION ALL
    SELECT 'discount_analysis', count(DISTINCT (category_id, category_name, coalesce(brand_name, '-')))
    FROM products WHERE discount_rate > 0
    UNION ALL
    SELECT 'top_products', least(count(*), 100) FROM products WHERE review_count >= 10 AND rating_average >= 3.5
    UNION ALL
    SELECT 'daily_summary', count(DISTINCT crawl_date) FROM products_raw""",
)
def _(spark, sf):
    daily = staged(views.products_daily(spark, sf), "daily")
    tables = gold.gold_tables(replay_state(daily), change_log(daily), views.products_raw(spark, sf))
    return reports.table_counts(tables)


@query(
    "footer_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, min({c}) AS least, max({c}) AS greatest FROM {t}"
        for t, c in (("orders", "o_orderkey"), ("part", "p_partkey"))
    ),
)
def _(spark, sf):
    counted = [reports.footer_counts(spark, {t: f"{sf}/{t}.parquet"}, c) for t, c in (("orders", "o_orderkey"), ("part", "p_partkey"))]
    return counted[0].unionByName(counted[1])
