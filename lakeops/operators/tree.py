"""Leaves of a category tree given as edges (id, parent_id, name, is_leaf)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from lakeops.session import checkpointed


def edges_of_nested(trees: DataFrame, json_column: str, levels: int) -> DataFrame:
    """Edges (id, parent_id, name, is_leaf) of nested objects {id, name, is_leaf, children: [...]}.

    Every row holds one tree as text, of at most ``levels`` levels; ids are text. What lies
    below the last level would be lost, so a tree that is deeper raises an error.
    """
    schema = None
    for _ in range(levels):
        children = ArrayType(schema) if schema else StringType()
        schema = StructType().add("id", "string").add("name", "string").add("is_leaf", "boolean").add("children", children)
    level = trees.select(F.from_json(F.col(json_column), schema).alias("n"), F.lit(None).cast("string").alias("up"))
    found = []
    for depth in range(levels):
        own = (F.col("n.id").alias("id"), F.col("up").alias("parent_id"), F.col("n.name").alias("name"))
        flag = F.coalesce("n.is_leaf", F.lit(False))
        if depth == levels - 1:
            rest = F.coalesce(F.json_array_length("n.children"), F.lit(0)) > 0
            flag = F.when(rest, F.raise_error(F.lit(f"a tree has more than {levels} levels"))).otherwise(flag)
        found.append(level.filter("n.id is not null").select(*own, flag.cast("boolean").alias("is_leaf")))
        if depth < levels - 1:
            level = level.select(F.col("n.id").alias("up"), F.explode("n.children").alias("n"))
    return reduce(DataFrame.unionByName, found)


def leaves(edges: DataFrame, node: str = "id", parent: str = "parent_id", is_leaf: str | None = "is_leaf") -> DataFrame:
    """Nodes marked as leaves or without children, not looking below a marked one.

    A walk that starts at the roots stops at a node that is marked, so what hangs below it
    is no leaf of the tree. Without a marked node that has children one join is enough.
    """
    parents = edges.select(F.col(parent).alias(node)).filter(F.col(node).isNotNull()).distinct()
    if is_leaf is None:
        return edges.join(parents, node, "left_anti").select(edges.columns)
    flag = F.coalesce(F.col(is_leaf), F.lit(False))
    marked = edges.join(parents.withColumn("_has_children", F.lit(True)), node, "left")
    inner = marked.filter("_has_children").select(F.col(node).alias("_node"), F.col(parent).alias("_up"), F.when(flag, True).alias("_own"))
    found = marked.filter(F.col("_has_children").isNull() | flag)
    if not inner.filter("_own").isEmpty():
        above = nearest_above(inner).filter("_found").select(F.col("_node").alias("_hidden_by"))
        found = found.join(above, F.col(parent) == F.col("_hidden_by"), "left_anti")
    return found.select(edges.columns)


def nearest_above(inner: DataFrame) -> DataFrame:
    """For every node of (_node, _up, _own): the nearest ``_own`` of itself and the nodes above it.

    Each round every node jumps to where the node it points to points, and takes over what that
    one has found, so that the way to the root halves: about log2(depth) joins. Returns
    (_node, _found, _whole); ``_whole`` is false for nodes that no root leads to, those of a
    cycle among them. A node with several parents raises an error.
    """
    if not inner.groupBy("_node").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        raise ValueError("the tree has a cycle, or a node with several parents")
    state = inner.select("_node", F.col("_up").alias("_jump"), F.col("_own").alias("_found"), F.col("_up").isNull().alias("_whole"))
    state = checkpointed(state)
    # a way that is longer than there are nodes goes round in a cycle
    for _ in range(state.count().bit_length() + 1):
        if state.filter("_jump is not null").isEmpty():
            break
        there = state.select(F.col("_node").alias("_at"), F.col("_jump").alias("_next"), F.col("_found").alias("_theirs"), F.col("_whole").alias("_there"))
        on_the_way = F.col("_jump").isNotNull()
        state = checkpointed(
            state.join(there, F.col("_jump") == F.col("_at"), "left").select(
                "_node",
                F.col("_next").alias("_jump"),
                F.coalesce("_found", "_theirs").alias("_found"),
                F.when(on_the_way, F.coalesce("_there", F.lit(False))).otherwise(F.col("_whole")).alias("_whole"),
            )
        )
    return state.select("_node", "_found", (F.col("_whole") & F.col("_jump").isNull()).alias("_whole"))


def leaves_under(
    edges: DataFrame,
    root_names: list[str],
    node: str = "id",
    parent: str = "parent_id",
    name: str = "name",
    is_leaf: str = "is_leaf",
) -> DataFrame:
    """Leaves below the named categories, each with the name of the nearest one above it.

    Only inner nodes are walked, in about log2(depth) joins; the leaves, nearly all of the
    tree, join once at the end. Nodes that no root leads to, such as those of a cycle, have
    no leaves here; an inner node with several parents raises an error.
    """
    leaf = F.coalesce(F.col(is_leaf), F.lit(False))
    chosen = F.when(F.col(name).isin(root_names), F.col(name))
    inner = edges.filter(~leaf).select(F.col(node).alias("_node"), F.col(parent).alias("_up"), chosen.alias("_own"))
    found = nearest_above(inner).filter(F.col("_whole") & F.col("_found").isNotNull())
    mains = found.select(F.col("_node").alias("_up"), F.col("_found").alias("_above"))
    main = F.coalesce(chosen, F.col("_above"))
    return (
        edges.filter(leaf)
        .join(mains, F.col(parent) == F.col("_up"), "left")
        .select(F.col(node), F.col(name), main.alias("main_category"))
        .filter(F.col("main_category").isNotNull())
    )
