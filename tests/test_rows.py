"""Expressions and row operators on literal rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeops.functions.dates import date_in_name, last_date_in_path
from lakeops.functions.listing import listing_flags, normalize_listing, normalize_variant
from lakeops.functions.pricing import in_thousands, popularity_score
from lakeops.functions.text import clean_name, price_move
from lakeops.guards import require_date, require_rows, require_table
from lakeops.operators import clean, nested, paging, tree
from lakeops.session import checkpointed
from tests.conftest import rows


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_dates_in_names_are_null_when_wrong(spark):
    assert one(spark, date_in_name(F.lit("raw_2024-06-11.json"))) == date(2024, 6, 11)
    assert one(spark, date_in_name(F.lit("raw.json"))) is None
    assert one(spark, date_in_name(F.lit("raw_2024-02-31.json"))) is None
    assert one(spark, last_date_in_path(F.lit("/b/2020-01-01/raw_2024-06-11.json"))) == date(2024, 6, 11)


def test_prices(spark):
    assert one(spark, in_thousands(F.lit(1250).cast("long"))) == 1.3
    score = popularity_score(F.lit(11), F.lit(4.5), F.lit(10), F.lit(20))
    assert one(spark, score) == pytest.approx(59.0)
    frame = spark.createDataFrame(
        [(1000, 2000, 1000, 50), (0, 2000, 5, 5), (100, None, None, 0)],
        "price long, original_price long, discount long, discount_rate int",
    )
    assert rows(clean.reprice(frame, 0.1)) == [(0, 2000, 5, 5), (90, None, 10, 10), (900, 2000, 1100, 55)]


def test_names_and_labels(spark):
    assert one(spark, clean_name(F.lit('a, "b"\n\r\'c'))) == "a - b c"
    assert one(spark, clean_name(F.lit("a,b\nc"), comma=" ", newline=None, drop="")) == "a b\nc"
    moves = [one(spark, price_move(F.lit(p), F.lit(q))) for p, q in ((2, 1), (1, 2), (1, 1))]
    assert moves == ["Tăng giá", "Giảm giá", "Không đổi"]
    assert one(spark, price_move(F.lit(1), F.lit(None).cast("int"))) == "Lần đầu ghi nhận"


def test_listing_shapes(spark):
    shapes = [
        '{"id": 1, "quantity_sold": {"value": 7, "text": "t"}, "price": 5, "original_price": 9}',
        '{"id": 2, "quantity_sold": 8, "original_price": 0, "list_price": 4, "brand_name": ""}',
        '{"id": "3", "quantity_sold": "9", "original_price": null, "brand_name": "B"}',
        '{"id": 4, "quantity_sold": {"text": "none"}, "price": "x"}',
        "not json",
    ]
    frame = spark.createDataFrame([(s,) for s in shapes], "value string")
    listed = normalize_listing(frame)
    assert rows(listed, "id", "price", "original_price", "brand_name", "quantity_sold") == [
        (None, 0, 0, "No Brand", 0),
        (1, 5, 9, "No Brand", 7),
        (2, 0, 4, "No Brand", 8),
        (3, 0, 0, "B", 9),
        (4, 0, 0, "No Brand", 0),
    ]
    assert rows(listed, "id", "sold_text", "sub_category")[1] == (1, "t", "Unknown")
    assert rows(normalize_variant(frame)) == rows(listed)
    flagged = spark.createDataFrame(
        [('{"id": 1, "impression_info": [{"metadata": {"is_ad": true, "verified": "1"}}]}',),
         ('{"id": 2, "impression_info": []}',), ('{"id": 3}',)],
        "value string",
    )
    assert rows(listing_flags(flagged, ["is_ad", "is_fast", "verified"]), "id", "is_ad", "is_fast", "verified") == [
        (1, 1, 0, 1), (2, 0, 0, 0), (3, 0, 0, 0)
    ]


def test_clean_trims_spaces_only(spark):
    frame = spark.createDataFrame(
        [(1, " a\t ", None, None, None, " b "), (None, "x", 1, 1, 1, "y")],
        "id long, name string, price long, discount_rate int, quantity_sold int, brand_name string",
    )
    assert rows(clean.clean_records(frame)) == [(1, "a\t", 0, 0, 0, "b")]


def test_stamps(spark):
    at = datetime(2024, 1, 2, 3)
    frame = spark.createDataFrame([(1, "2023-05-05"), (2, "soon")], "id long, own string")
    stamped = clean.stamp_batch(frame, "raw_2024-06-11.json", at, own_date="own")
    assert rows(stamped, "id", "crawl_date", "loaded_at", "is_active") == [
        (1, date(2023, 5, 5), at, True), (2, date(2024, 6, 11), at, True)
    ]
    events = spark.createDataFrame([(1, "2024-01-01", None), (2, "", False)], "id long, crawl_date string, is_active boolean")
    assert rows(clean.stamp_events(events, loaded_at=at), "id", "crawl_date", "is_active") == [
        (1, date(2024, 1, 1), None), (2, None, False)
    ]
    assert rows(clean.stamp_events(events, loaded_at=at, default_active=True), "is_active") == [(False,), (True,)]


def test_coercion_failures_are_quarantined(spark):
    frame = spark.createDataFrame([("1", "9.5"), ("2", "12x"), (None, None)], "id string, price string")
    good, bad = clean.split_errors(clean.coerce_types(frame, {"id": "long", "price": "double"}))
    assert rows(good) == [(None, None), (1, 9.5)]
    assert rows(bad) == [(2, None, "price")]


def test_nested(spark):
    frame = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id long, tags array<string>")
    assert rows(nested.explode_items(frame, "tags", "tag")) == [(1, "a"), (1, "b")]
    assert rows(nested.explode_items(frame, "tags", "tag", keep_empty=True)) == [(1, "a"), (1, "b"), (2, None), (3, None)]
    assert rows(nested.join_items(frame, "tags", "text", "none")) == [(1, "a, b"), (2, "none"), (3, "none")]
    attributes = spark.createDataFrame(
        [(1, [("x", "1"), ("y", "2"), ("x", "3")]), (2, [])], "id long, attrs array<struct<code:string,value:string>>"
    )
    assert rows(nested.attributes_to_columns(attributes, "attrs", {"x": ["x"], "any": ["y", "z"]})) == [
        (1, "3", "2"), (2, "N/A", "N/A")
    ]


def test_paging(spark):
    frame = spark.range(95)
    assert rows(paging.page_of(frame, ["id"], page=3, limit=40)) == [(n,) for n in range(80, 95)]
    assert rows(paging.page_summary(frame, page=3, limit=40)) == [(3, 3, 40, 95)]
    assert rows(paging.page_summary(frame.filter("id < 0"), limit=40)) == [(1, 0, 40, 0)]


def test_tree(spark):
    edges = spark.createDataFrame(
        [
            ("r", None, "Root", False), ("a", "r", "A", False), ("b", "r", "B", False), ("c", "a", "C", False),
            ("l1", "c", "L1", True), ("l2", "b", "L2", True), ("l3", "r", "L3", True), ("e", "b", "E", None),
            ("top", None, "A", True),
        ],
        "id string, parent_id string, name string, is_leaf boolean",
    )
    assert rows(tree.leaves(edges), "id") == [("e",), ("l1",), ("l2",), ("l3",), ("top",)]
    found = rows(tree.leaves_under(edges, ["Root", "A"]))
    assert found == [("l1", "L1", "A"), ("l2", "L2", "Root"), ("l3", "L3", "Root"), ("top", "A", "A")]
    cycle = spark.createDataFrame([("x", "y", "X", False), ("y", "x", "Y", False)], edges.schema)
    assert tree.leaves_under(cycle, ["X"]).count() == 0


def test_guards(spark):
    frame = spark.range(3)
    assert require_rows(frame) is frame
    with pytest.raises(ValueError, match="no rows"):
        require_rows(frame.filter("id < 0"))
    with pytest.raises(ValueError, match="does not exist"):
        require_table(spark, "nowhere")
    assert require_date("x_2024-06-11.json") == date(2024, 6, 11)
    with pytest.raises(ValueError, match="no date"):
        require_date("x.json")
    with pytest.raises(ValueError):
        require_date("x_2024-13-11.json")


def test_deep_pages_equal_shallow_ones(spark):
    data = [((n * 37) % 50 if n % 9 else None, f"k{n % 7}", n) for n in range(700)]
    frame = spark.createDataFrame(data, "a int, b string, c int").repartition(5)
    sort = [F.col("a").desc(), F.col("b"), F.col("c")]
    for page in (1, 2, 9, 17, 18, 40):
        deep = paging.deep_page(frame, ["-a", "b", "c"], page, 40, ranges=6)
        assert deep.collect() == frame.orderBy(*sort).offset((page - 1) * 40).limit(40).collect()
    up = paging.deep_page(frame, ["a", "-b", "c"], 3, 40, ranges=9).collect()
    assert up == frame.orderBy("a", F.col("b").desc(), "c").offset(80).limit(40).collect()
    assert paging.deep_page(frame.filter("c < 0"), ["c"], 1).collect() == []


def test_a_deep_page_of_many_ranges(spark):
    data = [((n * 37) % 50 if n % 9 else None, f"k{n % 7}" if n % 5 else None, n) for n in range(7000)]
    frame = spark.createDataFrame(data, "a int, b string, c int").repartition(5)
    sort = [F.col("a").desc(), F.col("b"), F.col("c").desc()]
    for page in (1, 90, 175):
        deep = paging.deep_page(frame, ["-a", "b", "-c"], page, 40, ranges=200)  # one per shuffle partition of a cluster
        assert deep.collect() == frame.orderBy(*sort).offset((page - 1) * 40).limit(40).collect()


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    chain = [(str(i), str(i - 1) if i else None, f"n{i}", False) for i in range(1000)] + [("leaf", "999", "leaf", True)]
    edges = spark.createDataFrame(chain, "id string, parent_id string, name string, is_leaf boolean")
    rounds = []
    monkeypatch.setattr(tree, "checkpointed", lambda df: rounds.append(1) or checkpointed(df))
    assert rows(tree.leaves_under(edges, ["n3", "n700"])) == [("leaf", "leaf", "n700")]
    assert len(rounds) <= 12
    lost = spark.createDataFrame([("x", "gone", "n", False), ("y", "x", "y", True)], edges.schema)
    assert tree.leaves_under(lost, ["n"]).count() == 0
