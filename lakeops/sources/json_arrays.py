"""Files that hold one JSON array each, read by many tasks.

Spark cuts a file into ranges of bytes and these into pieces at closing braces. Whether a piece
begins inside a string, and how deep in brackets, depends on all before it; but each range has a
plain effect on both for either beginning, and the effects of a file's ranges, one short row
each, are put together in order. With the state at its beginning known, every range then cuts its
text into elements by itself. What a range holds of an element that begins or ends in another one
is joined afterwards, at most two fragments a range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.session import staged

END = "}"
ESCAPED = re.compile(r"\\.", re.DOTALL)
BRACKETS = re.compile(r"[\[\]{},]")
WHOLE, GOES_ON, OPEN = 0, 1, 2


def pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, value): the text between closing braces, in order inside every block."""
    text = spark.read.option("lineSep", END).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def outside_strings(piece: str, in_string: bool) -> tuple[str, bool]:
    """The piece with its strings blanked, and whether its end is inside a string."""
    parts = ESCAPED.sub("__", piece).split('"')
    for i in range(0 if in_string else 1, len(parts), 2):
        parts[i] = "_" * len(parts[i])
    return '"'.join(parts), in_string != (len(parts) % 2 == 0)


def deeper(blanked: str) -> int:
    return sum(blanked.count(c) for c in "[{") - sum(blanked.count(c) for c in "]}")


def effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per block: its first character that is no space, and what it does to a state outside or inside a string."""
    known: dict[tuple, list] = {}
    for batch in batches:
        for file, block, value in zip(batch["file"], batch["block"], batch["value"], strict=True):
            row = known.setdefault((file, block), ["", [False, 0], [True, 0]])
            row[0] = row[0] or value.lstrip()[:1]
            for state in row[1:]:
                blanked, state[0] = outside_strings(value, state[0])
                state[1] += deeper(blanked) - (not state[0])  # the brace that ended the piece
    rows = [(*key, first, *out, *inside) for key, (first, out, inside) in known.items()]
    yield pd.DataFrame(rows, columns=["file", "block", "first", "out_ends", "out_deeper", "in_ends", "in_deeper"])


EFFECTS = "file string, block long, first string, out_ends boolean, out_deeper long, in_ends boolean, in_deeper long"


def starts(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state at the beginning of every block of one file, and whether the file is one whole array."""
    rows, in_string, depth = [], False, 0
    blocks = blocks.sort_values("block")
    for b in blocks.itertuples():
        rows.append([b.file, b.block, in_string, depth])
        end, more = (b.in_ends, b.in_deeper) if in_string else (b.out_ends, b.out_deeper)
        in_string, depth = bool(end), depth + more
    # behind the last piece of a file there is no brace
    whole = not in_string and depth + 1 == 0 and blocks["first"].iloc[0] == "["
    return pd.DataFrame([(*r, whole) for r in rows], columns=["file", "block", "in_string", "depth", "whole"])


class Cutter:
    """Cuts the pieces of one block, one after the other, into elements of the array."""

    def __init__(self, file: str, block: int, in_string: bool, depth: int):
        self.file, self.block, self.in_string, self.depth = file, block, in_string, depth
        self.text: list[str] = []
        self.begun = False  # whether the element began in this block
        self.over, self.number = False, 0

    def row(self, kind: int, text: str) -> tuple:
        row = (self.file, self.block + self.number, self.block, kind, text)
        # objects only, of which a block has fewer than bytes, so that positions rise along a file
        self.number += kind != GOES_ON and text.lstrip()[:1] == "{"
        return row

    def cut(self, piece: str) -> Iterator[tuple]:
        piece += END
        blanked, self.in_string = outside_strings(piece[:-1], self.in_string)
        blanked += "_" if self.in_string else END
        start = 0
        for found in BRACKETS.finditer(blanked):
            if self.over:
                return
            sign, at = found.group(), found.start()
            if sign in "[{":
                self.depth += 1
                if self.depth == 1:
                    start, self.begun = at + 1, True
            elif sign in "]}":
                self.depth -= 1
                if self.depth == 0:
                    yield from self.ended(piece[start:at])
                    self.over = True
            elif self.depth == 1:
                yield from self.ended(piece[start:at])
                start, self.begun = at + 1, True
        if self.depth and not self.over:
            self.text.append(piece[start:])

    def ended(self, last: str) -> Iterator[tuple]:
        text = "".join([*self.text, last])
        self.text = []
        if self.begun:
            yield self.row(WHOLE, text)
        else:
            yield self.row(GOES_ON, text)

    def rest(self) -> Iterator[tuple]:
        if self.text and not self.over:
            yield self.row(OPEN if self.begun else GOES_ON, "".join(self.text))


PARTS = "file string, position long, block long, kind int, text string"


def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole elements, and fragments of those that lie in several blocks."""
    columns = ["file", "position", "block", "kind", "text"]
    cutter: Cutter | None = None
    for batch in batches:
        rows: list[tuple] = []
        for file, block, in_string, depth, value in zip(*(batch[c] for c in ("file", "block", "in_string", "depth", "value")), strict=True):
            if cutter is None or (cutter.file, cutter.block) != (file, block):
                rows += cutter.rest() if cutter else []
                cutter = Cutter(file, block, bool(in_string), int(depth))
            rows += cutter.cut(value)
        yield pd.DataFrame(rows, columns=columns)
    yield pd.DataFrame(list(cutter.rest()) if cutter else [], columns=columns)


def array_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, position, text) of the objects in the arrays; files that are no whole array give none."""
    found = pieces(spark, path)
    states = found.mapInPandas(effects, EFFECTS).groupBy("file").applyInPandas(
        starts, "file string, block long, in_string boolean, depth long, whole boolean"
    )
    # one short row per block of bytes
    known = F.broadcast(staged(states.filter("whole").drop("whole"), "array-blocks"))
    cut = staged(found.join(known, ["file", "block"]).mapInPandas(parts, PARTS), "array-parts")
    fragments = cut.filter(F.col("kind") != WHOLE)
    order = W.partitionBy("file").orderBy("block", "kind").rowsBetween(W.unboundedPreceding, 0)
    numbered = fragments.withColumn("element", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    in_order = F.array_sort(F.collect_list(F.struct("block", "text")))
    joined = numbered.groupBy("file", "element").agg(
        F.min(F.when(F.col("kind") == OPEN, F.col("position"))).alias("position"),
        F.array_join(F.transform(in_order, lambda p: p["text"]), "").alias("text"),
    )
    whole = cut.filter(F.col("kind") == WHOLE).select("file", "position", "text")
    elements = whole.unionByName(joined.select("file", "position", "text"))
    return elements.filter(F.col("text").rlike(r"^\s*\{"))
