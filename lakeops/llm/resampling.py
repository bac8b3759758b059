"""Importance resampling towards a target distribution, with counts per distinct line.

Texts and target texts become bags of hashed word n-grams. Newlines cut the texts into lines,
equal lines are brought together by Spark, and the features inside a distinct line are counted
once and multiplied by how often the line occurs; a line that occurs once is not moved for it. The n-grams that cross from one line into the
next belong to no line; they are read off the last and first words beside each newline and added
to the counts. A bucket's gain is the logarithm of how much more frequent its features are in the
target, with one added to every count. A text's weight is the mean gain of its features, and
weights with seeded Gumbel noise draw without replacement: the highest scores are the sample.

The scores are whole numbers, of which there are few, so a histogram finds the lowest score that
is drawn, and only rows from there on are sorted, over ranges of scores and ids. A range never
holds more than its share, since rows equal in all else are told apart by a row number. What
goes through the driver is two arrays of ``buckets`` counts and one number per range.

Words are ``WORD`` runs of the text with A-Z in lower case. Defined results: a NULL text is
empty, has no features, weight 0, and cannot be drawn unless ``min_words`` is 0. A NULL id is
hashed like an empty one, and comes before all others among equal scores. Repeated rows are
counted and drawn each; rows equal in score and id are in the order of their features and weight.
Empty tables count as no features. Further columns are not carried along.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.llm import bitmaps
from lakeops.llm.registry import query, table
from lakeops.session import staged

#: words (letters, digits and all bytes beyond ASCII) in lower case, anything else as a space
_CLEAN = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256)
)
#: bytes of a text that are cut into words at a time
CHUNK = 1 << 20
#: features whose bucket a task remembers
MOST_FEATURES = 1 << 18


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_CLEAN).split()


def parts_of(text: str | None, longest: int) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text in parts, and how many at the start of a part are the last of the one before."""
    data, start, again = (text or "").encode().translate(_CLEAN), 0, []
    while start < len(data):
        end = data.find(b" ", start + CHUNK)
        end = len(data) if end < 0 else end
        words = again + data[start:end].split()
        yield words, len(again)
        again = words[len(words) - longest + 1 :] if longest > 1 else []
        start = end


class Buckets(dict):
    """The bucket of a feature."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MOST_FEATURES:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found

    def of(self, words: list[bytes], longest: int, again: int = 0) -> Iterator[int]:
        """The buckets of all runs of 1 to ``longest`` words that do not end among the first ``again`` ones."""
        yield from map(self.__getitem__, words[again:])
        for n in range(2, longest + 1):
            for i in range(max(0, again - n + 1), len(words) - n + 1):
                yield self[b" ".join(words[i : i + n])]


def crossing(text: str | None, longest: int) -> Iterator[bytes]:
    """The n-grams that begin in one line and end in a later one, each at the first newline it crosses."""
    words: list[bytes] = []
    ends = [0]
    for line in (text or "").split("\n"):
        if found := words_of(line):
            words += found
            ends.append(len(words))
    for begin, end in zip(ends[:-2], ends[1:-1], strict=True):
        for n in range(2, longest + 1):
            for i in range(max(begin, end - n + 1), min(end, len(words) - n + 1)):
                yield b" ".join(words[i : i + n])


def line_counts(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """(bucket, n) of the features inside lines: distinct lines counted once, times their occurrences.

    A bit map holds the hashes that several lines have; a line that it does not let pass occurs
    once, and is counted where it is read. Only the others are shuffled and brought together.
    """
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter("line != ''")
    hashed = F.xxhash64("line")
    several = lines.groupBy(hashed.alias("hash")).agg(F.count("*").alias("n")).filter("n > 1")
    parts = staged(bitmaps.parts_of(several, F.col("hash")), "resample-lines")
    marked = bitmaps.marked(lines, hashed, parts, "_again")
    once = marked.filter("NOT _again").select("line", F.lit(1).cast("long").alias("times"))
    often = marked.filter("_again").groupBy("line").agg(F.count("*").alias("times"))
    lines = once.unionByName(often)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for line, times in zip(batch["line"], batch["times"], strict=True):
                for words, again in parts_of(line, longest):
                    for bucket, n in Counter(known.of(words, longest, again)).items():
                        total[bucket] += n * times
        yield nonzero(total)

    return lines.mapInPandas(counted, "bucket int, n long")


def crossing_counts(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """(bucket, n) of the features that cross lines, from every text."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                for feature in crossing(text, longest):
                    total[known[feature]] += 1
        yield nonzero(total)

    return texts.filter(F.contains("text", F.lit("\n"))).mapInPandas(counted, "bucket int, n long")


def nonzero(total: np.ndarray) -> pd.DataFrame:
    found = np.flatnonzero(total)
    return pd.DataFrame({"bucket": found.astype(np.int32), "n": total[found]})


def bucket_counts(texts: DataFrame, buckets: int = 10_000, longest: int = 1) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``texts`` has a column ``text``."""
    parts = line_counts(texts, buckets, longest)
    if longest > 1:
        parts = parts.unionByName(crossing_counts(texts, buckets, longest))
    total = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The whole gain of every bucket, in thousandths of the natural logarithm."""
    buckets, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * float(all_s + buckets) / (float(s + 1) * float(all_t + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def features_and_weight(text: Column, gain: np.ndarray, longest: int) -> Column:
    """Struct of n_words, n_features and weight of a text."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Buckets(len(gain))
        for texts in batches:
            rows = []
            for text in texts:
                n_words = n_features = total = 0
                for words, again in parts_of(text, longest):
                    found = np.fromiter(known.of(words, longest, again), np.int64)
                    n_words += len(words) - again
                    n_features += len(found)
                    total += int(gain[found].sum())
                rows.append((n_words, n_features, total // n_features if n_features else 0))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    return measured(text)


def noise(key: Column, seed: int) -> Column:
    """Seeded standard Gumbel noise in whole thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with their place from 1 in a total order, as column ``rank``.

    They are sorted in ranges; a range's first place follows from the sizes of those before it.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # the upper bits are the number of the range, the lower ones the place in it
    placed = staged(placed.withColumn("_at", F.monotonically_increasing_id()), label)
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select(F.col("_part"), F.coalesce(before, F.lit(0)).alias("_before"))
    # one row per range
    placed = placed.join(F.broadcast(starts), part == F.col("_part"))
    return placed.withColumn("rank", inside + F.col("_before") + 1).drop("_at", "_part", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    buckets: int = 10_000,
    longest: int = 1,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """``id_col``, n_features, weight, score and rank of every text; texts that are not drawn have no rank."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    corpus = bucket_counts(texts.select("text"), buckets, longest)
    gain = gains(corpus, bucket_counts(target.select(F.col(target_col).alias("text")), buckets, longest))
    scored = texts.select("id", features_and_weight(F.col("text"), gain, longest).alias("m"))
    scored = scored.select("id", "m.*", (F.col("m.weight") + noise(F.col("id"), seed)).alias("score"))
    scored = staged(scored.withColumn("_row", F.monotonically_increasing_id()), "resample-scores")

    eligible = F.col("n_words") >= min_words
    histogram = scored.filter(eligible).groupBy("score").agg(F.count("*").alias("n"))
    # whole scores between the ends of gains and noise: some ten thousand rows, whatever the table holds
    higher = histogram.withColumn("upto", F.sum("n").over(W.orderBy(F.col("score").desc())))
    higher = higher.withColumn("quota", F.expr(f"sum(n) OVER () * {int(percent)} DIV 100"))
    lowest = higher.filter("upto - n < quota").agg(F.min("score"), F.max("quota")).first()

    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    no_rank = F.lit(None).cast("long").alias("rank")
    if lowest[0] is None:
        return scored.select(*columns, no_rank)
    near = eligible & (F.col("score") >= lowest[0])
    order = [F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("n_features"), F.col("weight"), F.col("_row")]
    drawn = ranked(scored.filter(near), order, "resample-ranks")
    drawn = drawn.select(*columns, F.when(F.col("rank") <= lowest[1], F.col("rank")).alias("rank"))
    return scored.filter(~near).select(*columns, no_rank).unionByName(drawn)


# crc32 from its rule: each byte goes through eight steps of the reversed polynomial 0xEDB88320
RESAMPLE_SQL = r"""
WITH steps AS (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i)
), crc AS (
    SELECT list(v ORDER BY i) AS t FROM steps
), documents_of AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), target_of AS (
    SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), occurrences AS (
    SELECT r, w, count(*) AS n FROM (SELECT r, unnest(words) AS w FROM documents_of) GROUP BY r, w
), wanted AS (
    SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM target_of) GROUP BY w
), vocabulary AS (
    SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(w))),
                      lambda k: ('0x' || substr(hex(encode(w)), (2 * k + 1)::BIGINT, 2))::BIGINT)),
                  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT w FROM occurrences UNION SELECT w FROM wanted), crc
), s AS (
    SELECT bucket, sum(n)::BIGINT AS n FROM occurrences JOIN vocabulary USING (w) GROUP BY bucket
), t AS (
    SELECT bucket, sum(n)::BIGINT AS n FROM wanted JOIN vocabulary USING (w) GROUP BY bucket
), gain AS (
    SELECT b AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0) + 10000)::DOUBLE
               / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS g
    FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
), weighed AS (
    SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * g) / sum(n))::BIGINT AS weight
    FROM occurrences JOIN vocabulary USING (w) JOIN gain USING (bucket) GROUP BY r
), scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
               + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents_of LEFT JOIN weighed USING (r)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20
                  ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS place,
           count(*) OVER (PARTITION BY n_features >= 20) AS eligible
    FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
FROM placed
"""


@query("op11_importance_resampling", RESAMPLE_SQL)
def op11_importance_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
