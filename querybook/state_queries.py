"""Change detection, merges, trees, history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakeops.functions.dates import day
from lakeops.operators import history, tree
from lakeops.operators.changes import detect_changes
from lakeops.operators.merge import delete_where, upsert, upsert_columns
from lakeops.plans.recovery import plan_recovery
from lakeops.session import scratch_path
from lakeops.sinks.state import StateTable
from lakeops.sinks.tables import bucketed_table
from querybook import views
from querybook.book import query
from querybook.sql_views import TIE

CHECKED = [
    "id", "name", "brand_name", "price", "original_price", "discount", "discount_rate",
    "rating_average", "review_count", "quantity_sold", "category_id", "is_active", "crawl_date", "source_file",
]
COLUMNS = ", ".join(CHECKED)
TRACKED = ["price", "original_price", "discount", "discount_rate"]


@query(
    "cdc_changes",
    f"""
    SELECT {", ".join("n." + c for c in CHECKED)} FROM batch_2001 n LEFT JOIN state_2000 c ON n.id = c.id
    WHERE c.id IS NULL OR {" OR ".join(f"n.{c} <> c.{c}" for c in TRACKED)}""",
)
def _(spark, sf):
    return detect_changes(views.last_batch(spark, sf), views.state_before(spark, sf)).select(CHECKED)


@query(
    "cdc_changes_nullsafe",
    f"""
    SELECT {", ".join("n." + c for c in CHECKED)} FROM batch_2001 n LEFT JOIN state_2000 c ON n.id = c.id
    WHERE c.id IS NULL OR {" OR ".join(f"n.{c} IS DISTINCT FROM c.{c}" for c in TRACKED)}""",
)
def _(spark, sf):
    batch, state = views.last_batch(spark, sf), views.state_before(spark, sf)
    return detect_changes(batch, state, null_safe=True, small_batch=True).select(CHECKED)


def full_join(pick: str) -> str:
    """Oracle of a merge as a full join; ``pick`` builds the expression of one column."""
    columns = ", ".join(f"{pick.replace('#', c)} AS {c}" for c in CHECKED)
    return f"SELECT {columns} FROM state_2000 t FULL JOIN batch_2001 s ON t.id = s.id"


@query("merge_upsert", full_join("CASE WHEN s.id IS NULL THEN t.# ELSE s.# END"))
def _(spark, sf):
    # a snapshot has one row per product
    return upsert(views.state_before(spark, sf), views.last_batch(spark, sf), on_duplicate="unique").select(CHECKED)


@query(
    "merge_duplicates",
    f"""
    WITH latest AS (
        SELECT {COLUMNS} FROM products_raw WHERE year(crawl_date) >= 1998
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC, loaded_at DESC, {TIE}) = 1)
    SELECT {COLUMNS} FROM latest
    UNION ALL
    SELECT {COLUMNS} FROM (SELECT * FROM products_daily WHERE crawl_date <= DATE '1997-01-01'
                           QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC) = 1)
    WHERE id NOT IN (SELECT id FROM latest)""",
)
def _(spark, sf):
    daily = views.products_daily(spark, sf)
    state = history.as_of(daily, ["id"], ["crawl_date"], day("1997-01-01"), tie_break=[])
    batch = views.products_raw(spark, sf).filter(F.col("crawl_date") >= day("1998-01-01"))
    state = state.withColumns({c: F.lit(None).cast("long") for c in ("l_orderkey", "l_linenumber", "l_suppkey")})
    return upsert(state, batch, order=["crawl_date", "loaded_at", *views.TIE]).select(CHECKED)


@query(
    "merge_soft_delete",
    f"""
    SELECT {", ".join("CASE WHEN s.id IS NULL THEN t.# ELSE s.# END AS #".replace("#", c) for c in CHECKED
                      if c != "is_active")},
           CASE WHEN s.id IS NOT NULL THEN s.is_active
                WHEN t.category_id IN (SELECT category_id FROM batch_2001) THEN false
                ELSE t.is_active END AS is_active
    FROM state_2000 t FULL JOIN batch_2001 s ON t.id = s.id""",
)
def _(spark, sf):
    state, batch = views.state_before(spark, sf), views.last_batch(spark, sf)
    return upsert(state, batch, snapshot_scope="category_id", on_duplicate="unique").select(CHECKED)


@query("merge_bucketed", full_join("CASE WHEN s.id IS NULL THEN t.# ELSE s.# END"))
def _(spark, sf):
    state, batch = bucketed(spark, sf)
    return upsert(state, batch, on_duplicate="unique").select(CHECKED)


def bucketed(spark, sf):
    """State and batch as tables that are split and sorted by product."""
    folder = scratch_path(spark, "bucketed")
    label = folder.rsplit("-", 1)[-1]
    for part, rows in (("state", views.state_before(spark, sf)), ("batch", views.last_batch(spark, sf))):
        bucketed_table(rows, f"querybook_{part}_{label}", f"{folder}/{part}", "id", 8)
    return (spark.table(f"querybook_{part}_{label}") for part in ("state", "batch"))


PARTIAL = ["price", "discount_rate", "rating_average", "review_count", "quantity_sold"]


@query(
    "merge_partial",
    "SELECT "
    + ", ".join(
        (f"CASE WHEN s.id IS NULL THEN t.{c} ELSE s.{c} END" if c in PARTIAL
         else f"CASE WHEN t.id IS NULL THEN s.{c} ELSE t.{c} END") + f" AS {c}"
        for c in CHECKED
    )
    + " FROM state_2000 t FULL JOIN batch_2001 s ON t.id = s.id",
)
def _(spark, sf):
    state, batch = views.state_before(spark, sf), views.last_batch(spark, sf)
    return upsert_columns(state.select(CHECKED), batch.select(CHECKED), PARTIAL)


@query(
    "delete_where",
    f"SELECT {COLUMNS} FROM products WHERE (brand_name = 'Brand#7') IS NOT TRUE",
)
def _(spark, sf):
    return delete_where(views.products(spark, sf), F.col("brand_name") == "Brand#7").select(CHECKED)


def edges(spark, sf):
    """Regions, nations and customers as one tree; customers are its leaves."""
    region, nation, customer = (views.table(spark, sf, t) for t in ("region", "nation", "customer"))

    def node(df, key, prefix, parent, name, is_leaf):
        return df.select(
            F.concat(F.lit(prefix), key).alias("id"),
            parent.alias("parent_id"),
            F.col(name).alias("name"),
            F.lit(is_leaf).alias("is_leaf"),
        )

    regions = node(region, "r_regionkey", "R", F.lit(None).cast("string"), "r_name", False)
    nations = node(nation, "n_nationkey", "N", F.concat(F.lit("R"), "n_regionkey"), "n_name", False)
    leaves = node(customer, "c_custkey", "C", F.concat(F.lit("N"), "c_nationkey"), "c_name", True)
    return regions.unionByName(nations).unionByName(leaves)


EDGES = """
    SELECT 'R' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS name, false AS is_leaf FROM region
    UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name, false FROM nation
    UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_name, true FROM customer"""


@query(
    "tree_leaves",
    f"""
    WITH edges AS ({EDGES})
    SELECT id, parent_id, name FROM (SELECT id, parent_id, name, is_leaf OR id = 'N5' AS is_leaf FROM edges) e
    WHERE parent_id IS DISTINCT FROM 'N5'
      AND (is_leaf OR NOT EXISTS (SELECT 1 FROM edges c WHERE c.parent_id = e.id))""",
)
def _(spark, sf):
    # a nation marked as a leaf, although customers hang below it
    marked = edges(spark, sf).withColumn("is_leaf", F.col("is_leaf") | (F.col("id") == "N5"))
    return tree.leaves(marked).select("id", "parent_id", "name")


@query(
    "tree_edges",
    """
    SELECT 'R' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS name, false AS is_leaf FROM region
    UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name, n_nationkey % 2 = 0 FROM nation""",
)
def _(spark, sf):
    nation = views.table(spark, sf, "nation")
    child = F.struct(
        F.concat(F.lit("N"), "n_nationkey").alias("id"), F.col("n_name").alias("name"), (F.col("n_nationkey") % 2 == 0).alias("is_leaf")
    )
    children = nation.groupBy("n_regionkey").agg(F.collect_list(child).alias("children"))
    region = views.table(spark, sf, "region").join(children, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    whole = F.struct(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), "children")
    return tree.edges_of_nested(region.select(F.to_json(whole).alias("tree")), "tree", levels=3)


@query(
    "tree_leaves_by_root",
    f"""
    WITH RECURSIVE edges AS ({EDGES}),
    walk AS (
        SELECT id, name, is_leaf, CASE WHEN name IN ('AFRICA', 'ASIA', 'NATION_7') THEN name END AS main_category
        FROM edges WHERE parent_id IS NULL
        UNION ALL
        SELECT e.id, e.name, e.is_leaf,
               CASE WHEN e.name IN ('AFRICA', 'ASIA', 'NATION_7') THEN e.name ELSE w.main_category END
        FROM edges e JOIN walk w ON e.parent_id = w.id)
    SELECT id, name, main_category FROM walk WHERE is_leaf AND main_category IS NOT NULL""",
)
def _(spark, sf):
    return tree.leaves_under(edges(spark, sf), ["AFRICA", "ASIA", "NATION_7"])


@query(
    "state_as_of",
    f"""
    SELECT {COLUMNS} FROM products_daily WHERE crawl_date <= DATE '1998-06-30'
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date DESC) = 1""",
)
def _(spark, sf):
    daily = views.products_daily(spark, sf)
    return history.as_of(daily, ["id"], ["crawl_date"], day("1998-06-30"), tie_break=[]).select(CHECKED)


@query(
    "rollback_state",
    f"""
    SELECT {COLUMNS} FROM state_2000 WHERE id NOT IN (SELECT id FROM batch_2001 WHERE id % 3 = 0)
    UNION ALL SELECT {COLUMNS.replace("price,", "price + 1,", 1)} FROM batch_2001 WHERE id % 3 = 0""",
)
def _(spark, sf):
    state = StateTable(spark, scratch_path(spark, "rollback"))
    times = [datetime(2024, 1, day) for day in (1, 2, 3, 4)]
    state.append(views.state_before(spark, sf), "first", times[0])
    batch = views.last_batch(spark, sf)
    state.append(batch, "bad", times[1], snapshot=True)
    state.rollback(times[0], times[2])
    # a load after the rollback builds on what was rolled back to
    state.append(batch.filter("id % 3 = 0").withColumn("price", F.col("price") + 1), "good", times[3])
    return state.read().select(CHECKED)


@query(
    "retain_last_n",
    """
    SELECT id, l_orderkey, l_linenumber, price, crawl_date FROM products_raw
    WHERE crawl_date IN (SELECT DISTINCT crawl_date FROM products_raw ORDER BY crawl_date DESC LIMIT 3)""",
)
def _(spark, sf):
    kept = history.retain_last_n(views.load_rows(spark, sf), "crawl_date", 3)
    return kept.select("id", "l_orderkey", "l_linenumber", "price", "crawl_date")


@query(
    "version_log",
    """
    SELECT crawl_date, source_file, CAST(min(loaded_at) AS DATE) AS first_loaded, CAST(max(loaded_at) AS DATE) AS last_loaded,
           count(*) AS row_count
    FROM products_raw GROUP BY crawl_date, source_file""",
)
def _(spark, sf):
    return history.version_log(views.load_rows(spark, sf)).select(
        "crawl_date",
        "source_file",
        F.col("first_loaded_at").cast("date").alias("first_loaded"),
        F.col("last_loaded_at").cast("date").alias("last_loaded"),
        "row_count",
    )


@query("replay_history", f"SELECT {COLUMNS} FROM price_history")
def _(spark, sf):
    return views.price_history(spark, sf).select(CHECKED)


@query("replay_active", f"SELECT {COLUMNS} FROM products")
def _(spark, sf):
    return views.products(spark, sf).select(CHECKED)


@query(
    "recovery_plan",
    """
    WITH days AS (SELECT crawl_date, count(DISTINCT id) AS n FROM products_raw
                  WHERE crawl_date >= DATE '1997-01-01' GROUP BY crawl_date)
    SELECT 'replay' AS step, crawl_date, n AS product_count FROM days
    UNION ALL SELECT 'gold', max(crawl_date), CAST(sum(n) AS BIGINT) FROM days""",
)
def _(spark, sf):
    return plan_recovery(views.load_rows(spark, sf), from_date="1997-01-01")
