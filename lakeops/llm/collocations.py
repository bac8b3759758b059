"""Phrase collocations from sorted count streams.

Counting goes by phrase length. Every task numbers the words of a block in their order, counts the
phrases as sorted numbers and sends sorted runs, one per language and share of the phrases, which
the shuffle brings together and an aggregation merges. A phrase can only be frequent if its first and its last words
are, so that longer phrases are counted where a bit map of the frequent shorter ones lets them
pass; the map has a fixed size, and what it lets pass wrongly falls to the exact count.

The frequent phrases of all lengths form one stream of (language, words, count). It is kept in two
orders: by the words from the first on (prefix order) and by the words from the last on (suffix
order). Both are sorted over ranges, so that no phrase or word can make a hot group. One pass
along a stream holds just the open path: a phrase stands behind all its prefixes, and before the
phrases that extend it. The pass in prefix order gives every phrase the counts of its first words
(left counts) and the largest count of an extension to the right; the one in suffix order the
counts of its last words (right counts) and the extensions to the left. Nothing is looked up in a
hash table. Where a range begins in the middle of a path, the counts above are missing; these few
border phrases, at most one per range and length, are filled in afterwards.

Words are ``[^\\x20\\x09]+`` of the pieces between ``[.,;:!?\\x0A-\\x0D]``, A-Z in lower case. Defined
results: a NULL text is empty; a NULL language is ``und``, together with rows of that name.
Repeated rows count each. A phrase inside a longer one of the same words but another place counts
at each place. Equal scores are told apart by count and phrase. An empty table gives an empty
result. Further columns are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.llm import bitmaps
from lakeops.llm.registry import query, table
from lakeops.session import staged

#: the end of a piece; no text in UTF-8 has this byte
BORDER = b"\xff"
#: A-Z in lower case, the ends of pieces as borders, tabs as spaces
_CLEAN = bytes(
    i + 32 if 65 <= i <= 90 else 255 if i in b".,;:!?" or 10 <= i <= 13 else 32 if i == 9 else i for i in range(256)
)
_GAP = re.compile(rb"[\x20\xff]")
#: words that a task counts before it sends runs, and bytes of a text that it cuts into words at a time
BLOCK_WORDS = 1 << 21
CHUNK = 1 << 20
#: the seed of Spark's XXH64, and by how many bits the hash of each further word is turned
HASH_SEED, TURN = 42, 21
#: shares of the phrases per shuffle partition; they follow from other bits of the hash than the map
SHARES, MAP_SHIFT = 2, 40


def words_of(text: bytes, longest: int) -> Iterator[list[bytes]]:
    """The words and borders of a text, in parts; the last ``longest`` - 1 words of a part come again in the next."""
    text, start, again = text.translate(_CLEAN), 0, []
    while start < len(text):
        gap = _GAP.search(text, start + CHUNK)
        end = gap.start() if gap else len(text)
        words = again + text[start:end].replace(BORDER, b" \xff ").split()
        yield words
        again = words[len(words) - longest + 1 :] if longest > 1 else []
        start = end


class Numbers(dict):
    """Words by the order in which they come; the border is 0."""

    def __init__(self):
        super().__init__({BORDER: 0})

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def turned(hashes: np.ndarray, times: int) -> np.ndarray:
    by = np.uint64(TURN * times % 64)
    return hashes << by | hashes >> (np.uint64(64) - by) if by else hashes


def may_pass(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Block:
    """Words of one language, of which the phrases of ``n`` words are counted."""

    def __init__(self, lang: str, n: int):
        self.lang, self.n = lang, n
        self.numbers, self.parts, self.size = Numbers(), [], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(words)

    def counted(self, bits: np.ndarray | None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Phrases in the order of their words, how often each stands here, and their hashes."""
        n, words = self.n, pa.array(list(self.numbers), pa.binary())
        order = pc.sort_indices(words).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words, ids, border = words.take(order), rank[np.concatenate(self.parts)], rank[0]
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, HASH_SEED) for w in words.to_pylist()), np.uint64, len(words))

        def hash_at(at: np.ndarray, length: int) -> np.ndarray:
            found = np.full(len(at), xxhash.xxh64_intdigest(self.lang.encode(), HASH_SEED), np.uint64)
            for k in range(length):
                found ^= turned(hashes[ids[at + k]], k)
            return found

        starts = np.arange(max(0, len(ids) - n + 1))
        whole = np.ones(len(starts), bool)
        for k in range(n):
            whole &= ids[k : k + len(starts)] != border
        starts = starts[whole]
        if n > 1:
            starts = starts[may_pass(hash_at(starts, n - 1), bits)]
            starts = starts[may_pass(hash_at(starts + 1, n - 1), bits)]
        # a number for the first words and one for the next word, in the order of both
        code = ids[starts]
        for k in range(1, n):
            if k > 1:
                code = np.unique(code, return_inverse=True)[1]
            code = code << 32 | ids[starts + k]
        _, first, times = np.unique(code, return_index=True, return_counts=True)
        at = starts[first]
        phrases = words.take(ids[at])
        for k in range(1, n):
            phrases = pc.binary_join_element_wise(phrases, words.take(ids[at + k]), b" ")
        found = hash_at(at, n)
        if n == 1:
            total = pa.array([b""], pa.binary())
            phrases = pa.concat_arrays([total, phrases])
            times, found = np.insert(times, 0, whole.sum()), np.insert(found, 0, np.uint64(0))
        return phrases, times, found

    def runs(self, bits: np.ndarray | None, shares: int) -> pa.RecordBatch:
        """One row per share of the phrases: language, share, phrases one per line, times."""
        phrases, times, hashes = self.counted(bits)
        share = (hashes >> np.uint64(MAP_SHIFT)) % np.uint64(shares)
        order = np.argsort(share, kind="stable")
        found, starts = np.unique(share[order], return_index=True)
        ends = pa.array(np.append(starts, len(order)), pa.int32())
        lines = pc.binary_join(pa.ListArray.from_arrays(ends, phrases.take(order)), b"\n").cast(pa.string())
        times = pa.ListArray.from_arrays(ends, pa.array(times[order], pa.int64()))
        langs = pa.array([self.lang] * len(found), pa.string())
        return pa.RecordBatch.from_arrays([langs, pa.array(found, pa.int32()), lines, times], ["lang", "share", "phrases", "times"])


def counts(docs: DataFrame, n: int, bits: bytes | None) -> DataFrame:
    """(lang, phrase, a) of the phrases of ``n`` words; for single words also the phrase ``""``, of all words.

    ``docs`` has columns lang and text. Longer phrases are counted where their first and their
    last n - 1 words are in the bit map.
    """
    shares = SHARES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def counted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = None if bits is None else np.frombuffer(bits, np.uint8)
        blocks: dict[str, Block] = {}
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                for words in words_of(text or b"", n):
                    if lang not in blocks:
                        blocks[lang] = Block(lang, n)
                    blocks[lang].add(words)
                    if blocks[lang].size >= BLOCK_WORDS:
                        yield blocks.pop(lang).runs(passing, shares)
            if sum(b.size for b in blocks.values()) >= BLOCK_WORDS:
                yield from (b.runs(passing, shares) for b in blocks.values() if b.size)
                blocks = {}
        yield from (b.runs(passing, shares) for b in blocks.values() if b.size)

    sent = docs.mapInArrow(counted_runs, "lang string, share int, phrases string, times array<long>")
    pairs = F.arrays_zip(F.split("phrases", "\n").alias("phrase"), F.col("times").alias("a"))
    merged = sent.repartition("share").select("lang", "share", F.explode(pairs).alias("p"))
    merged = merged.select("lang", "share", F.col("p.phrase").alias("phrase"), F.col("p.a").alias("a"))
    # the rows of a share are in one task by now: no further shuffle
    return merged.groupBy("lang", "share", "phrase").agg(F.sum("a").alias("a")).drop("share")


def bit_map(frequent: DataFrame, n: int, bits: int = bitmaps.MAP_BITS) -> bytes:
    """A bit for the hash of every (lang, phrase of ``n`` words), in a map of 2^bits bits whatever their number."""
    words, hashed = F.split("phrase", " "), F.xxhash64("lang")
    for k in range(n):
        one, by = F.xxhash64(F.get(words, F.lit(k))), TURN * k % 64
        hashed = hashed.bitwiseXOR(F.shiftleft(one, by).bitwiseOR(F.shiftrightunsigned(one, 64 - by)) if by else one)
    return bitmaps.as_bytes(bitmaps.parts_of(frequent, hashed, bits), bits)


def along(stream: DataFrame, label: str) -> DataFrame:
    """(lang, words, a, before, extension) of a stream (lang, words, a) by one pass in the order of its words.

    ``before`` has the counts of the phrase's first 1, 2, ... words, ``extension`` the largest
    count of a phrase with one word more at the end. A phrase that opens in one range and goes on
    in the next has further rows there, with an ``extension`` and without ``a``.
    """
    columns = ["lang", "words", "a", "before", "extension", "part"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        path: list[list] = []  # the open phrases, each with one word more: rows as in ``columns``
        for batch in batches:
            closed = []
            for lang, words, a in zip(batch["lang"], batch["words"], batch["a"], strict=True):
                words = list(words)
                while path and (path[-1][0] != lang or words[: len(path)] != path[-1][1]):
                    closed.append(path.pop())
                while len(path) < len(words) - 1:
                    path.append([lang, words[: len(path) + 1], None, [p[2] for p in path], None, part])
                if path:
                    path[-1][4] = max(path[-1][4] or 0, a)
                path.append([lang, words, a, [p[2] for p in path], None, part])
            yield framed(closed)
        yield framed(path)

    def framed(rows: list[list]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns).astype({"a": "Int64", "extension": "Int64"})

    ranges = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stream.repartitionByRange(ranges, "lang", "words").sortWithinPartitions("lang", "words")
    schema = "lang string, words array<string>, a long, before array<long>, extension long, part int"
    passed = staged(ordered.mapInPandas(scan, schema), label)

    # at most one per range and length
    borders = passed.filter("a IS NULL").select("part", "lang", "words")
    known = stream.join(F.broadcast(borders), ["lang", "words"])
    above = known.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct(F.size("words").alias("n"), "a"))).alias("above")
    )
    filled = F.transform("before", lambda x, i: F.coalesce(x, F.col("above")[i + 1]))
    whole = passed.join(F.broadcast(above), "part", "left")
    return whole.select("lang", "words", "a", F.when(F.col("a").isNotNull(), filled).alias("before"), "extension")


def collocations(
    docs: DataFrame,
    longest: int = 3,
    min_count: int = 10,
    absorb_percent: int = 50,
    top: int | None = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
    map_bits: int = bitmaps.MAP_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of 2 to ``longest`` words of each language.

    A phrase is left out if one that holds it is at least ``absorb_percent`` per cent as frequent.
    The score is that of the lowest-scoring cut, in millionths of a * a / (l * r).
    """
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    frequent, bits = [], None
    for n in range(1, longest + 1):
        enough = (F.col("a") >= min_count) | (F.col("phrase") == "")
        found = staged(counts(docs, n, bits).filter(enough), f"collocations-{n}")
        if n == 1:
            totals = found.filter("phrase = ''").select("lang", F.col("a").alias("n"))
            found = found.filter("phrase != ''")
        frequent.append(found)
        if n < longest:
            bits = bit_map(found, n, map_bits)
    stream = reduce(DataFrame.unionByName, frequent).select("lang", F.split("phrase", " ").alias("words"), "a")
    turned = stream.withColumn("words", F.reverse("words"))

    nothing = F.lit(None).cast("array<long>")
    left = along(stream, "collocations-prefix").withColumn("after", nothing)
    right = along(turned, "collocations-suffix").withColumn("words", F.reverse("words"))
    right = right.withColumnRenamed("before", "after").withColumn("before", nothing)
    both = left.unionByName(right).groupBy("lang", "words")
    phrases = both.agg(*(F.max(c).alias(c) for c in ("a", "before", "after", "extension"))).filter("size(words) > 1")
    phrases = phrases.filter(~F.coalesce(100 * F.col("extension") >= absorb_percent * F.col("a"), F.lit(False)))

    cut = """named_struct(
        'score', CAST(1000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0))
                 DIV (CAST(before[k - 1] AS DECIMAL(19, 0)) * CAST(after[size(words) - k - 1] AS DECIMAL(19, 0))),
        'k', k, 'l', before[k - 1], 'r', after[size(words) - k - 1])"""
    lowest = F.expr(f"array_min(transform(sequence(1, size(words) - 1), k -> {cut}))")
    scored = phrases.select("lang", F.array_join("words", " ").alias("phrase"), "a", lowest.alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM split
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    FROM split
), f AS MATERIALIZED (
    SELECT lang, size, phrase, count(*) AS a FROM phrases GROUP BY ALL
), totals AS (
    SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS MATERIALIZED (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10
), frequent AS MATERIALIZED (
    SELECT lang, phrase, a FROM f WHERE a >= 10
), parts AS MATERIALIZED (
    SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS left_part, array_to_string(w[k + 1:], ' ') AS right_part
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), inside AS (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM candidates WHERE size = 3
), longer AS (
    SELECT lang, phrase, max(a) AS a FROM inside GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r,
           ((1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT) // (l.a::HUGEINT * r.a::HUGEINT))::BIGINT AS score
    FROM parts c
    JOIN frequent l ON l.lang = c.lang AND l.phrase = c.left_part
    JOIN frequent r ON r.lang = c.lang AND r.phrase = c.right_part
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, c.phrase) AS rank
    FROM lowest c LEFT JOIN longer x ON x.lang = c.lang AND x.phrase = c.phrase
    WHERE x.a IS NULL OR 100 * x.a < 50 * c.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", COLLOCATIONS_SQL)
def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
