"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is 1 if it is set in over half of the XXH64 values of a text's word
shingles. For a radius r, every bit position gets a random vector of r + 1 bits, and every
non-zero vector v of r + 1 bits gives a table: its mask holds the positions whose vector has
an odd product with v. Any r positions leave some v without an odd product among them, and
so every pair within the radius agrees on the whole mask of some table. Buckets of at most
``small_bucket`` different fingerprints compare their members. A larger bucket splits each
member into the balls of radius r / 2 around it that lie in the bucket's free positions: two
members meet in a ball exactly if they are within the radius, so that a ball links its
members in a star without comparing them. (For an odd r, the balls have radius r // 2 and
one flip more, and their members are compared.) Equal fingerprints are one node throughout.
Components grow by alternating large-star and small-star rounds.

Defined results: a NULL or empty text has fingerprint 0 and links like any other. A document
without ``doc_id`` can link others, and has no say in the smallest id; a component without
any id has a NULL id. Repeated rows stay, with the same result. An empty table gives an
empty result. Other columns are kept by ``one_per_class`` and not used elsewhere.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm import bitmaps
from lakeops.llm.registry import query, table
from lakeops.session import checkpointed, staged

BITS = 64
HASH_SEED = 42
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    set_bits = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], ">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(starts)).tobytes(), "big")


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of a text column, as a signed long of the same 64 bits."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = [fingerprint((t or "").encode(), shingle) for t in texts]
            yield pd.Series(np.array(values, np.uint64).view(np.int64))

    return of(text)


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """2^(radius + 1) - 1 masks; any ``radius`` positions are all free in one of them at least."""
    drawn = random.Random(seed)
    vectors = [drawn.randrange(1, 1 << (radius + 1)) for _ in range(BITS)]
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))
    ]


def flips(value: Column, free: Column, times: int) -> Column:
    """All values within ``times`` flips of the free positions, each once."""
    found = F.array(value)
    for _ in range(times):
        found = F.array_distinct(
            F.concat(found, F.flatten(F.transform(found, lambda x: F.transform(free, lambda m: x.bitwiseXOR(m)))))
        )
    return found


def links(nodes: DataFrame, radius: int = 2, small_bucket: int = 32) -> DataFrame:
    """Pairs (a, b), a > b, whose chains link all ``fp`` of ``nodes`` within the radius, and no others.

    ``nodes`` has different fingerprints only, and should be cheap to read several times.
    """
    if radius < 1:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    masks = covering_masks(radius)
    tables = F.array(*(F.struct(F.lit(n).alias("t"), F.lit(signed(m)).alias("m")) for n, m in enumerate(masks)))
    keyed = nodes.select("fp", F.explode(tables).alias("of"))
    keyed = keyed.select("fp", F.col("of.t").alias("t"), F.col("fp").bitwiseAND(F.col("of.m")).alias("key"))
    # buckets of one need no further step
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = checkpointed(keyed.join(sizes, ["t", "key"]))

    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    small = shared.filter(F.col("n") <= small_bucket).drop("n")
    pairs = small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), ["t", "key"])
    pairs = pairs.filter((F.col("a") > F.col("b")) & near).select("a", "b")

    free = F.array(
        *(F.array(*(F.lit(signed(1 << i)) for i in range(BITS) if not m >> i & 1)) for m in masks)
    )
    around = flips(F.col("fp"), F.element_at(free, F.col("t") + 1), (radius + 1) // 2)
    balls = shared.filter(F.col("n") > small_bucket).select("fp", "t", F.explode(around).alias("ball"))
    if radius % 2 == 0:
        centre = balls.groupBy("t", "ball").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
        stars = balls.join(centre.drop("n"), ["t", "ball"]).filter("fp > b").select(F.col("fp").alias("a"), "b")
    else:
        left, right = balls.withColumnRenamed("fp", "a"), balls.withColumnRenamed("fp", "b")
        stars = left.join(right, ["t", "ball"]).filter((F.col("a") > F.col("b")) & near).select("a", "b")
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(a, b): every node that has a link, but the smallest of its component, and that smallest node."""
    edges = checkpointed(edges)
    state = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpointed(large.filter("a > b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        edges = checkpointed(small.distinct())
        found = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if found == state:
            return edges
        state = found
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def with_roots(nodes: DataFrame, radius: int, small_bucket: int = 32) -> DataFrame:
    """``nodes`` with different fingerprints ``fp``, and the smallest one of the component as ``root``."""
    roots = components(links(nodes.select("fp"), radius, small_bucket))
    rooted = nodes.join(roots.withColumnRenamed("a", "fp"), "fp", "left")
    return rooted.withColumn("root", F.coalesce("b", "fp")).drop("b")


def classes(marked: DataFrame, radius: int = 2, id_col: str = "doc_id", small_bucket: int = 32) -> DataFrame:
    """(fp, component_id) for every fingerprint ``fp`` of ``marked``."""
    nodes = checkpointed(marked.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    rooted = with_roots(nodes, radius, small_bucket)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, fingerprint (16 hex digits) and component_id of every document."""
    marked = staged(docs.select(F.col(id_col).alias("id"), fingerprints(F.col(text_col), shingle).alias("fp")), "simhash")
    found = classes(marked, radius, "id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(found, "fp").select(F.col("id").alias(id_col), hexed, "component_id")


def row_key(key: Column, text: Column) -> Column:
    """A hash of an id and a text, either of which may be NULL."""

    def marked(value: Column) -> Column:
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.unhex(F.sha2(F.concat(marked(key), marked(text)), 256))


def one_per_class(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id, one without an id last.

    Of rows of a class that repeat the id, the one with the smallest fingerprint, and then the
    smallest hash of id and text, stays; of rows equal in both, that with the smallest other
    columns. A row is known by its hash. A bit map of a fixed size holds the hashes of the rows
    that go or repeat; only rows that it lets pass are joined with these hashes and shuffled with
    their texts, all others stay without.
    """
    hashed = row_key(F.col(id_col).cast("string"), F.col(text_col))
    print_of = fingerprints(F.col(text_col), shingle).alias("fp")
    marked = staged(docs.select(F.col(id_col).alias("id"), hashed.alias("_key"), print_of), "simhash")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp", "_key")).alias("first")
    nodes = checkpointed(marked.groupBy("fp").agg(least))
    kept = with_roots(nodes, radius).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select("first._key", F.lit(True).alias("_stays"))
    per_key = marked.groupBy("_key").agg(F.count("*").alias("n")).join(kept, "_key", "left")
    special = staged(per_key.filter("_stays IS NULL OR n > 1").select("_key", "_stays"), "simhash-special")

    keyed = docs.withColumn("_key", hashed)
    parts = staged(bitmaps.parts_of(special, F.xxhash64("_key")), "simhash-map")
    keyed = bitmaps.marked(keyed, F.xxhash64("_key"), parts, "_passes")
    passing = keyed.filter("_passes")
    out = keyed.filter("NOT _passes").unionByName(passing.join(special, "_key", "left_anti")).select(docs.columns)
    again = special.filter("_stays")
    if again.isEmpty():
        return out
    rest = F.to_json(F.struct(*docs.columns))
    row = F.min_by(F.struct(*docs.columns), F.struct(text_col, rest)).alias("row")
    repeated = passing.join(again, "_key", "left_semi").groupBy("_key").agg(row).select("row.*")
    return out.unionByName(repeated)


@query("op5_simhash_components")
def op5_simhash_components(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
