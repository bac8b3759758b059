"""NULL logic, keys, scopes and idempotence of change detection and merges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeops.guards import require_unique
from lakeops.operators.changes import detect_changes, drop_stale
from lakeops.operators.merge import delete_where, upsert, upsert_columns
from lakeops.operators.tree import edges_of_nested, leaves, leaves_under
from tests.conftest import rows

SCHEMA = "id long, price long, original_price long, discount long, discount_rate int, category_id int, is_active boolean"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture()
def state(spark):
    return frame(
        spark,
        (1, 100, 120, 20, 10, 7, True),
        (2, 100, None, None, 10, 7, True),
        (3, 100, 120, 20, 10, 8, True),
        (4, 100, 120, 20, 10, None, True),
    )


def test_changes_follow_three_valued_logic(spark, state):
    new = frame(
        spark,
        (1, 100, None, None, 10, 7, True),  # value to NULL: unseen
        (2, 100, 120, 20, 10, 7, True),  # NULL to value: unseen
        (3, 90, None, None, 10, 8, True),  # another column differs
        (9, 1, 1, 1, 1, 1, True),  # unknown key
        (None, 1, 1, 1, 1, 1, True),  # no key matches nothing
    )
    assert rows(detect_changes(new, state), "id") == [(None,), (3,), (9,)]
    assert rows(detect_changes(new, state, null_safe=True), "id") == [(None,), (1,), (2,), (3,), (9,)]


def test_small_batch_gives_the_same_changes(spark, state):
    new = frame(spark, (1, 90, 120, 20, 10, 7, True), (3, 100, 120, 20, 10, 8, True), (5, 1, 1, 1, 1, 1, True))
    assert rows(detect_changes(new, state, small_batch=True)) == rows(detect_changes(new, state))


def test_matched_null_overwrites(spark, state):
    merged = upsert(state, frame(spark, (1, 50, None, None, None, 7, None)))
    assert (1, 50, None, None, None, 7, None) in rows(merged)
    assert merged.count() == 4


def test_soft_delete_scope_is_the_categories_of_the_snapshot(spark, state):
    snapshot = frame(spark, (1, 100, 120, 20, 10, 7, True), (5, 1, 1, 1, 1, None, True))
    merged = upsert(state, snapshot, snapshot_scope="category_id")
    assert rows(merged, "id", "is_active") == [(1, True), (2, False), (3, True), (4, True), (5, True)]


def test_soft_delete_of_a_whole_absent_category(spark, state):
    moved = frame(spark, (3, 100, 120, 20, 10, 7, True))
    merged = upsert(state, moved, snapshot_scope="category_id")
    assert rows(merged, "id", "is_active") == [(1, False), (2, False), (3, True), (4, True)]


def test_merge_is_idempotent(spark, state):
    batch = frame(spark, (2, 1, 2, 1, 3, 7, True), (6, 1, 2, 1, 3, 9, True))
    once = upsert(state, batch, snapshot_scope="category_id")
    assert rows(upsert(once, batch, snapshot_scope="category_id")) == rows(once)


def test_partial_upsert_touches_only_the_named_columns(spark, state):
    batch = frame(spark, (1, 5, 6, 7, 8, 9, False), (10, 5, 6, 7, 8, 9, False))
    merged = upsert_columns(state, batch, ["price", "discount"])
    assert (1, 5, 120, 7, 10, 7, True) in rows(merged)
    assert (10, 5, 6, 7, 8, 9, False) in rows(merged)
    assert merged.count() == 5
    assert merged.columns == state.columns


def test_delete_keeps_rows_with_an_unknown_predicate(spark, state):
    assert rows(delete_where(state, F.col("original_price") == 120), "id") == [(2,)]


def test_stale_events_are_dropped(spark):
    current = spark.createDataFrame([(1, 10), (2, 10)], "id long, at long")
    batch = spark.createDataFrame([(1, 9), (2, 10), (3, 1)], "id long, at long")
    assert rows(drop_stale(batch, current, "at")) == [(2, 10), (3, 1)]


def test_duplicate_keys_can_be_an_error(spark, state):
    assert require_unique(state, ["id"]) is state
    with pytest.raises(ValueError, match="several rows"):
        require_unique(state.unionByName(state), ["id"])


def test_duplicate_keys_of_a_batch(spark, state):
    batch = frame(spark, (1, 50, None, None, None, 7, None), (1, 60, None, None, None, 7, None), (None, 1, None, None, None, 7, None))
    merged = upsert(state, batch, order=["price"])
    assert rows(merged.filter("id = 1"), "price") == [(60,)]
    assert merged.filter("id is null").count() == state.filter("id is null").count() + 1
    with pytest.raises(ValueError, match="several rows"):
        upsert(state, batch, on_duplicate="error")
    with pytest.raises(ValueError, match="unknown"):
        upsert(state, batch, on_duplicate="first")


def test_stale_rows(spark):
    current = spark.createDataFrame([(1, 5), (2, 5)], "id int, at int")
    batch = spark.createDataFrame([(1, 4), (2, 5), (2, None), (3, 1)], "id int, at int")
    assert rows(drop_stale(batch, current, "at")) == [(2, None), (2, 5), (3, 1)]


def test_leaves_stop_at_a_marked_node(spark):
    edges = [("a", None, False), ("a1", "a", True), ("a2", "a", False), ("x", "a1", False), ("y", "x", True), ("b", None, None)]
    frame = spark.createDataFrame([(i, p, i, leaf) for i, p, leaf in edges], "id string, parent_id string, name string, is_leaf boolean")
    assert rows(leaves(frame), "id") == [("a1",), ("a2",), ("b",)]
    deep = spark.createDataFrame([(str(i), str(i - 1) if i else None, "root" if not i else "n", i == 12) for i in range(13)], frame.schema)
    assert rows(leaves_under(deep, ["root"])) == [("12", "n", "root")]
    ring = spark.createDataFrame([("r", None, "r", False), ("p", "r", "p", False), ("q", "p", "q", False), ("p", "q", "p", False)], frame.schema)
    with pytest.raises(ValueError, match="cycle"):
        leaves_under(ring, ["r"])


def test_edges_of_a_nested_tree(spark):
    text = '{"id": 1, "name": "a", "children": [{"id": 2, "name": "b", "is_leaf": true}, {"id": 3, "name": "c", "children": []}]}'
    trees = spark.createDataFrame([(text,), (None,)], "value string")
    expected = [("1", None, "a", False), ("2", "1", "b", True), ("3", "1", "c", False)]
    assert rows(edges_of_nested(trees, "value", 2)) == rows(edges_of_nested(trees, "value", 5)) == expected
    with pytest.raises(Exception, match="more than 1 levels"):
        edges_of_nested(trees, "value", 1).collect()
