"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget in proportion to its weight. A source whose share
passes ``max_epochs`` times its own size is clamped there, and the excess goes to the others
by weight until nobody is above. A target is then met by whole repetitions of every document
of the source and one fractional repetition: documents in a seeded order, until the rest of
the target is used up; the document at the end gives its leading words only. The order is
found from a histogram over hash buckets, so that only the rows of one bucket per source are
ever sorted, whatever share of the table a source holds. They are sorted over ranges, and the
words before a range follow from the sums of the ranges before it, so that not even a bucket of
one repeated row meets in one task.

Defined results: a text that is NULL or has no word has size 0 and is taken 0 words. Rows
without a source form one source, the last one. A NULL ``doc_id`` hashes like an empty text;
the hash also takes in the text, so rows that share an id are apart.
Repeated rows count as documents of their own. An empty table gives an empty result. Columns of
the input named like an added one are replaced, and those that start with an underscore are left
out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.llm.registry import cleared, query, table
from lakeops.session import staged

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_BITS = 12
HASH_BITS = 60
ADDED = ("size", "source_size", "target", "whole", "extra", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(key: Column, text: Column, seed: int) -> Column:
    """A whole number below 2^60 that depends on seed, key and text only."""
    parts = (F.coalesce(c.cast("string"), F.lit("")) for c in (key, text))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def water_fill(sizes: DataFrame, weights: tuple[int, ...], budget: float, max_epochs: int) -> DataFrame:
    """Targets of sources: ``sizes`` has one row (source, source_size) per source.

    The sources are weighted by ``weights`` in turn, in code point order with NULL last.
    One row per source is all that this step orders.
    """
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    cap = F.col("source_size") * max_epochs
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    rows = rows.withColumn("cap", cap)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    tightest = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = tightest.rowsBetween(W.unboundedPreceding, -1)
    share = F.lit(budget) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # the level of all sources from this one on, if the ones before it are clamped
    rows = rows.withColumn("level", share / weight_left)
    rows = rows.withColumn("clamped", F.col("level") * F.col("weight") > F.col("cap"))
    # behind the first source that is not clamped the level only falls
    level = F.max(F.when(~F.col("clamped"), F.col("level"))).over(everything)
    cap = F.col("cap").cast("double")
    target = F.when(F.col("clamped"), cap).otherwise(F.least(level * F.col("weight"), cap))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    budget: float = 1.5,
    max_epochs: int = 2,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size: Column | None = None,
    hashed: Column | None = None,
) -> DataFrame:
    """``docs`` with size, source_size, target, whole, extra and taken (in words).

    ``whole`` is how often the mix repeats all of a document, ``extra`` how many leading
    words it takes once more. ``size`` and ``hashed`` replace the word count of the text and
    the seeded hash of id and text.
    """
    given = {"size": word_count(F.col(text_col)) if size is None else size}
    given["_hash"] = seeded_hash(F.col(id_col), F.col(text_col), seed) if hashed is None else hashed
    kept = cleared(docs, *ADDED).columns
    docs = docs.select(*(F.col(f"`{c}`") for c in kept), *(c.alias(name) for name, c in given.items()))
    docs = docs.withColumn("_bucket", F.shiftright("_hash", HASH_BITS - BUCKET_BITS))

    buckets = staged(
        docs.groupBy(F.col(source_col).alias("source"), F.col("_bucket").alias("bucket")).agg(
            F.sum("size").alias("words")
        ),
        "mix-buckets",
    )
    targets = water_fill(
        buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget, max_epochs
    )
    full = F.col("source_size") > 0
    targets = targets.withColumn("whole", F.when(full, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = targets.withColumn("rest", F.floor("target") - F.col("whole") * F.col("source_size"))
    # the bucket in which the rest runs out, and what is left of it there
    edges = buckets.join(targets.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
    upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
    edges = edges.withColumn("upto", upto).filter(F.col("upto") > F.col("rest"))
    edges = edges.groupBy(F.col("_of").alias("_source")).agg(
        F.min("bucket").alias("_edge"),
        F.min_by(F.col("rest") - F.col("upto") + F.col("words"), "bucket").alias("_left"),
    )
    # a source taken whole, or without any word, has no edge
    plain = targets.select(F.col("source").alias("_source"), "source_size", "target", "whole")
    edges = plain.join(
        edges.select(F.col("_source").alias("_of"), "_edge", "_left"),
        F.col("_source").eqNullSafe(F.col("_of")),
        "left",
    ).drop("_of")
    edges = staged(edges, "mix-edges")

    joined = docs.join(edges, F.col(source_col).eqNullSafe(F.col("_source")))
    at_edge = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    inside = with_words_before(joined.filter(at_edge), id_col).withColumn(
        "extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left") - F.col("_so_far")))
    ).drop("_so_far")
    before = F.coalesce(F.col("_bucket") < F.col("_edge"), F.lit(False))
    outside = joined.filter(~at_edge).withColumn("extra", F.when(before, F.col("size")).otherwise(F.lit(0)))
    mixed = outside.unionByName(inside)
    mixed = mixed.withColumn("taken", F.col("whole") * F.col("size") + F.col("extra"))
    return mixed.drop("_source", "_edge", "_left", "_hash", "_bucket")


def with_words_before(rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with column _so_far: the words of their source's rows before them.

    They are sorted over ranges; a row number splits rows that are equal in source, hash and id.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("_source").asc_nulls_first(), F.col("_hash"), F.col(id_col).asc_nulls_first(), F.col("size"), F.col("_row")]
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_row")
    # the upper bits are the number of the range, the lower ones the place in it
    placed = staged(placed.withColumn("_at", F.monotonically_increasing_id()), "mix-places")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    sums = placed.groupBy("_source", "_range").agg(F.sum("size").alias("_words"))
    earlier = W.partitionBy("_source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(
        F.col("_source").alias("_of"),
        F.col("_range").alias("_in"),
        F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_earlier"),
    )
    here = W.partitionBy("_source", "_range").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumn("_here", F.sum("size").over(here) - F.col("size"))
    placed = placed.join(sums, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in")))
    return placed.withColumn("_so_far", F.col("_earlier") + F.col("_here")).drop(
        "_at", "_range", "_here", "_of", "_in", "_earlier"
    )


def repeated(mixed: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents of the mix: each as often as it is taken, a fractional one cut after its words.

    A cut text keeps its white space between words. ``length_col`` is brought up to date.
    """
    size, extra = F.col("size"), F.col("extra")
    full = F.when(size > 0, F.col("whole") + (extra == size).cast("long")).otherwise(0)
    words = F.split(F.col(text_col), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(words, 1, extra.cast("int")), "")
    copies = F.concat(
        F.array_repeat(F.col(text_col), full.cast("int")),
        F.when((extra > 0) & (extra < size), F.array(cut)).otherwise(F.array().cast("array<string>")),
    )
    columns = [F.explode(copies).alias(c) if c == text_col else F.col(c) for c in mixed.columns]
    out = mixed.select(*columns)
    if length_col in out.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(mixed.schema[length_col].dataType))
    return out.drop(*ADDED)


MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, 2 * source_size AS cap,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
    FROM sources
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER tight, 0)::DOUBLE)
              / (sum(w) OVER () - coalesce(sum(w) OVER tight, 0))::DOUBLE AS level
    FROM weighted
    WINDOW tight AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
    SELECT source, source_size,
           CASE WHEN level * w > cap THEN cap::DOUBLE
                ELSE least((max(level) FILTER (level * w <= cap) OVER ()) * w, cap::DOUBLE) END AS target
    FROM levels
), placed AS (
    SELECT d.doc_id, d.size, f.source_size, f.target,
           CASE WHEN f.source_size > 0 THEN floor(f.target / f.source_size)::BIGINT ELSE 0 END AS whole,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id NULLS FIRST, d.size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
    FROM sized d JOIN filled f ON d.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, floor(target)::BIGINT - whole * source_size - before)))::BIGINT AS taken
FROM placed
"""


@query("op9_mix_sources", MIX_SQL)
def op9_mix_sources(spark, sf_dir):
    size, hashed = word_count(F.col("text")).alias("n"), seeded_hash(F.col("doc_id"), F.col("text"), 42).alias("h")
    docs = staged(table(spark, sf_dir, "documents").select("doc_id", "source", size, hashed), "mix-sizes")
    mixed = mix(docs, size=F.col("n"), hashed=F.col("h"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
