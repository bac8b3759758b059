"""Bit maps of a fixed size that tell which rows may belong to a set, whatever the size of the set.

A member always has its bit set; a row that is no member has it set by chance, the likelier the
more members there are. What passes has to be checked exactly. A map is a table of at most
2^(bits - 15) parts of 4 KB, so that it can be sent to every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^25 bits are 4 MB
MAP_BITS = 25
#: bits of one part, as Spark's bitmap functions lay them out
PART_BITS = 15


def place(hashed: Column, bits: int) -> Column:
    return hashed.bitwiseAND(F.lit((1 << bits) - 1))


def parts_of(members: DataFrame, hashed: Column, bits: int = MAP_BITS) -> DataFrame:
    """(part, bits) of the map that holds the hash of every row of ``members``."""
    at = place(hashed, bits) + 1  # the functions count from 1
    return members.groupBy((F.bitmap_bucket_number(at) - 1).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def as_bytes(parts: DataFrame, bits: int = MAP_BITS) -> bytes:
    """The whole map on the driver, for tasks in Python."""
    whole = bytearray(1 << (bits - 3))
    for part, of_part in parts.collect():
        whole[part * len(of_part) : (part + 1) * len(of_part)] = of_part
    return bytes(whole)


def marked(rows: DataFrame, hashed: Column, parts: DataFrame, flag: str, bits: int = MAP_BITS) -> DataFrame:
    """``rows`` with column ``flag``: false where the row is certainly no member."""
    at = place(hashed, bits)
    inside = at.bitwiseAND(F.lit((1 << PART_BITS) - 1))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(inside, 3).cast("int") + 1, F.lit(1))), 16, 10)
    found = F.getbit(byte.cast("int"), inside.bitwiseAND(F.lit(7)).cast("int")) == 1
    of_row = parts.select(F.col("part").alias("_part"), F.col("bits").alias("_bits"))
    joined = rows.join(F.broadcast(of_row), F.shiftright(at, PART_BITS) == F.col("_part"), "left")
    return joined.select(*(F.col(f"`{c}`") for c in rows.columns), F.coalesce(found, F.lit(False)).alias(flag))
