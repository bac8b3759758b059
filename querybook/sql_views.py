"""The derived tables in DuckDB SQL, for the result checks."""

from __future__ import annotations

import re

TIE = """l_orderkey DESC NULLS LAST, l_linenumber DESC NULLS LAST, l_suppkey DESC NULLS LAST,
    price DESC NULLS LAST, original_price DESC NULLS LAST, discount_rate DESC NULLS LAST,
    quantity_sold DESC NULLS LAST, rating_average DESC NULLS LAST"""

CHANGED = """(price <> lag(price) OVER h OR original_price <> lag(original_price) OVER h
    OR discount <> lag(discount) OVER h OR discount_rate <> lag(discount_rate) OVER h)"""

VIEWS = {
    "products_raw": """
        SELECT l_partkey AS id, 'SKU' || l_partkey AS sku, p_name AS name,
               lower(replace(p_name, ' ', '-')) AS url_key,
               CAST(floor(l_extendedprice) AS BIGINT) AS price,
               CASE WHEN l_orderkey % 23 <> 0
                    THEN CAST(floor(l_extendedprice * (1 + l_tax)) AS BIGINT) END AS original_price,
               CASE WHEN l_orderkey % 23 <> 0
                    THEN CAST(floor(l_extendedprice * (1 + l_tax)) AS BIGINT)
                         - CAST(floor(l_extendedprice) AS BIGINT) END AS discount,
               CAST(floor(l_discount * 100 + 0.5) AS INT) * 5 AS discount_rate,
               CASE WHEN l_partkey % 13 = 0 THEN 'No Brand' WHEN l_partkey % 17 = 0 THEN ' '
                    WHEN l_partkey % 19 = 0 THEN NULL ELSE p_brand END AS brand_name,
               3 + floor(l_tax * 100 + 0.5) / 4 AS rating_average,
               l_linenumber * 5 AS review_count,
               '/img/' || l_partkey || '.jpg' AS thumbnail_url,
               p_size AS category_id, p_type AS category_name,
               CAST(l_quantity AS INT) AS quantity_sold,
               true AS is_active,
               'products_raw_' || year(l_shipdate) || '-01-01.json' AS source_file,
               l_shipdate AS loaded_at,
               CAST(date_trunc('year', l_shipdate) AS DATE) AS crawl_date,
               l_orderkey, l_linenumber, l_suppkey
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "products_daily": f"""
        SELECT * EXCLUDE (l_orderkey, l_linenumber, l_suppkey) FROM products_raw
        QUALIFY row_number() OVER (PARTITION BY id, crawl_date
                                   ORDER BY loaded_at DESC NULLS LAST, {TIE}) = 1""",
    "price_history": f"""
        SELECT * FROM products_daily
        WINDOW h AS (PARTITION BY id ORDER BY crawl_date)
        QUALIFY row_number() OVER h = 1 OR {CHANGED}""",
    "category_days": """
        SELECT category_id, max(crawl_date) AS until FROM products_daily GROUP BY category_id""",
    "products": """
        SELECT p.* REPLACE (p.is_active AND NOT coalesce(c.until > p.crawl_date, false) AS is_active)
        FROM (SELECT * FROM products_daily
              QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC) = 1) p
        LEFT JOIN category_days c ON c.category_id = p.category_id""",
    "state_2000": """
        SELECT * FROM products_daily WHERE crawl_date <= DATE '2000-01-01'
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC) = 1""",
    "batch_2001": """
        SELECT * FROM products_daily WHERE crawl_date = DATE '2001-01-01'""",
    "stream_events": """
        SELECT event_id, user_id AS id, 'user-' || user_id AS name,
               CAST(round(value * 100) AS BIGINT) AS price,
               CAST(round(value * 100) AS BIGINT) + k AS original_price,
               CASE WHEN k % 10 <> 0 THEN k END AS discount,
               CAST(k % 60 AS INT) AS discount_rate, CAST(k AS INT) AS quantity_sold,
               CAST(user_id % 10 AS INT) AS category_id,
               CASE WHEN event_type <> 'error' THEN k % 17 <> 0 END AS is_active,
               CAST(ts AS DATE) AS crawl_date, upper(event_type) AS _event_type,
               CAST(least((day(ts) - 1) // 10, 2) AS INT) AS epoch
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "stream_log": f"""
        SELECT * FROM (SELECT * FROM stream_events
                       QUALIFY row_number() OVER (PARTITION BY id, epoch ORDER BY event_id DESC) = 1)
        WINDOW h AS (PARTITION BY id ORDER BY epoch)
        QUALIFY row_number() OVER h = 1 OR {CHANGED}""",
    "listing": """
        SELECT p_partkey AS id, 'SKU' || p_partkey AS sku, p_name AS name,
               CAST(floor(p_retailprice) AS BIGINT) AS price, p_brand AS brand_name,
               p_size AS category_id, p_type AS category_name, p_size * 2 AS discount_rate,
               p_size * 11 AS quantity_sold
        FROM part""",
    "nested_products": """
        SELECT p_partkey AS id, p_name AS product_name,
               {'name': p_brand, 'is_official': p_size % 2 = 0} AS seller,
               [x FOR x IN [CASE WHEN p_size > 25 THEN 'big' END, CASE WHEN p_size % 3 = 0 THEN 'free delivery' END,
                            CASE WHEN p_type = 'PROMO' THEN 'promo' END] IF x IS NOT NULL] AS badges,
               [x FOR x IN [CASE WHEN p_size % 2 = 0 THEN {'id': p_size, 'name': p_type} END,
                            CASE WHEN p_size % 5 = 0 THEN {'id': p_size + 100, 'name': p_brand} END]
                IF x IS NOT NULL] AS categories
        FROM part""",
}


def with_views(sql: str) -> str:
    """``sql`` preceded by the views it names, and the views those name, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    joiner = ", " if sql.lstrip().upper().startswith("WITH ") else " "
    rest = sql.lstrip()[5:] if joiner == ", " else sql
    return f"WITH {views}{joiner}{rest}"
