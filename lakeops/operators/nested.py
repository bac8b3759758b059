"""Structs, arrays and attribute lists to flat columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import label_if_empty

# Fixed value: what a missing attribute becomes.
NO_ATTRIBUTE = "N/A"


def flatten(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Columns and nested fields (``struct.field``) under new names."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def explode_items(df: DataFrame, array: str, item: str, keep_empty: bool = False) -> DataFrame:
    """One row per array element; ``keep_empty`` keeps rows with an empty or NULL array."""
    spread = F.explode_outer if keep_empty else F.explode
    others = [c for c in df.columns if c != array]
    return df.select(*others, spread(array).alias(item))


def explode_structs(df: DataFrame, array: str, fields: Mapping[str, str], keep_empty: bool = True) -> DataFrame:
    """One row per struct element, its fields as columns (output name to field name)."""
    others = [c for c in df.columns if c != array]
    rows = explode_items(df, array, "_item", keep_empty)
    return rows.select(*others, *[F.col("_item")[field].alias(name) for name, field in fields.items()])


def join_items(df: DataFrame, array: str, text: str, if_empty: str, separator: str = ", ") -> DataFrame:
    """The array as one text, a label where it is empty."""
    others = [c for c in df.columns if c != array]
    joined = F.concat_ws(separator, F.col(array))
    return df.select(*others, label_if_empty(joined, if_empty).alias(text))


def attributes_to_columns(
    df: DataFrame, array: str, columns: Mapping[str, list[str]], default: str = NO_ATTRIBUTE
) -> DataFrame:
    """One column per list of attribute codes, from an array of (code, value); a later match wins."""

    def last_value(codes: list[str]):
        matching = F.filter(F.col(array), lambda attribute: attribute["code"].isin(codes))
        return F.coalesce(F.try_element_at(matching, F.lit(-1))["value"], F.lit(default))

    others = [c for c in df.columns if c != array]
    return df.select(*others, *[last_value(codes).alias(name) for name, codes in columns.items()])
