"""URL filters: host word segmentation and naive Bayes.

Rules (a host suffix and a path prefix) decide first; the longest rule that fits wins. The
other URLs are judged by a classifier. Names that stand together in a host are split into
words: word counts over the visible text of all pages give a unigram model, and the most
likely split is found by the Viterbi algorithm. Only words that occur inside some name are
matched against the counts, by a join on the word, so that no dictionary is ever held in one
place; equal names are split once. The tokens of the split host and of the path then go to a
multinomial naive Bayes classifier that learns from all URLs that a rule decides. Its counts
are kept by hash, in a fixed number of cells.

Defined results: a URL that is NULL or has no ``://`` has an empty host and path; it has no
tokens, and the classifier answers by the shares of its two classes. A tie, and any URL while
there is nothing to learn from, is allowed. A NULL page text counts no words. Repeated rows are
judged, and learnt from, each. An empty table gives an empty result. Columns of the input named
like an added one are replaced, and those that start with an underscore are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.licenses import LOWER, UPPER
from lakeops.llm.registry import cleared, query, table
from lakeops.session import staged

ALLOW, BLOCK = "allow", "block"
# The rules as (verdict, host, path prefix).
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
CELLS = 1 << 16
#: letters of an unknown piece of a name at most; counted words have no such limit
LONGEST_WORD = 20
INVISIBLE = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#0-9a-z]+;"


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with host and path."""
    rest = F.regexp_extract(F.col(url_col), r"(?s)^.*?://(.*)$", 1)
    host = lowered(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return pages.withColumns({"host": host, "path": path})


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with the rule that decides them (or NULL) and its verdict."""
    decided, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for result, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        of_host = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = of_host & F.col("path").startswith(path)
        decided = F.when(fits, host + path).otherwise(decided)
        verdict = F.when(fits, result).otherwise(verdict)
    return pages.withColumns({"rule": decided, "_decided": verdict})


def word_counts(pages: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over the visible text: runs of a-z."""
    seen = F.regexp_replace(F.col(text_col), INVISIBLE, " ")
    words = pages.select(F.explode(F.split(lowered(seen), "[^a-z]+")).alias("word"))
    words = words.filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def split_name(name: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The most likely split of a name; of equally likely ones that with the shorter last word.

    An unknown word of n letters is as likely as 1 / (total * 10^(n - 1)): any known word beats it.
    """
    best, back = [0.0], [0]
    long_words: dict[int, list[int]] = {}
    for start, stop in known:
        if stop - start > LONGEST_WORD:
            long_words.setdefault(stop, []).append(start)
    for stop in range(1, len(name) + 1):
        choices = []
        for start in range(stop - 1, max(-1, stop - LONGEST_WORD - 1), -1):
            cost = known.get((start, stop))
            if cost is None:
                cost = log(total) + (stop - start - 1) * log(10) + log(2)
            choices.append((best[start] + cost, stop - start))
        choices += [(best[start] + known[start, stop], stop - start) for start in long_words.get(stop, ())]
        cost, size = min(choices)
        best.append(cost)
        back.append(size)
    words, stop = [], len(name)
    while stop:
        words.append(name[stop - back[stop] : stop])
        stop -= back[stop]
    return words[::-1]


def split_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) for different ``name``s of letters, by the unigram model of ``counts``.

    Words of more than ``LONGEST_WORD`` letters are joined by their first ones, and then compared.
    """
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    length = F.length("name")
    parts = names.select("name", F.explode(F.sequence(F.lit(0), length - 1)).alias("start"))
    ends = F.sequence(F.col("start") + 1, F.least(length, F.col("start") + LONGEST_WORD))
    parts = parts.select("name", "start", F.explode(ends).alias("stop"))
    parts = parts.withColumn("word", F.substring(F.col("name"), F.col("start") + 1, F.col("stop") - F.col("start")))
    found = parts.join(counts, "word").select("name", "start", "stop", "n")
    longer = counts.filter(F.length("word") > LONGEST_WORD)
    longer = longer.select(F.substring("word", 1, LONGEST_WORD).alias("word"), F.col("word").alias("whole"), "n")
    begun = parts.filter(F.col("stop") - F.col("start") == LONGEST_WORD).join(longer, "word")
    begun = begun.filter(F.col("name").substr(F.col("start") + 1, F.length("whole")) == F.col("whole"))
    found = found.unionByName(begun.select("name", "start", (F.col("start") + F.length("whole")).alias("stop"), "n"))
    found = found.withColumn("cost", log(total) - F.log("n"))
    found = found.groupBy("name").agg(F.collect_list(F.struct("start", "stop", "cost")).alias("known"))
    rows = names.join(found, "name", "left")

    @F.pandas_udf("array<string>")
    def of(name: pd.Series, known: pd.Series) -> pd.Series:
        out = []
        for n, spans in zip(name, known, strict=True):
            costs = {} if spans is None else {(s["start"], s["stop"]): s["cost"] for s in spans}
            out.append(split_name(n, costs, total))
        return pd.Series(out, dtype=object)

    return rows.select("name", of("name", "known").alias("words"))


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) for different hosts: its names in their order, each split."""
    names = hosts.select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("place", "name")).filter("name <> ''")
    split = split_names(names.select("name").distinct(), counts)
    joined = names.join(split, "name").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "words"))).alias("w"))
    return joined.select("host", F.flatten(F.transform("w", lambda x: x["words"])).alias("words"))


def cells_of(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(CELLS)).cast("int"))


def learn(decided: DataFrame) -> tuple[np.ndarray, float]:
    """Log odds of BLOCK against ALLOW for each cell, and for the classes, from (_cells, _decided).

    At most ``CELLS`` rows for each class reach the driver.
    """
    classes = {r["_decided"]: r["count"] for r in decided.groupBy("_decided").count().collect()}
    if len(classes) < 2:
        return np.zeros(CELLS), 0.0 if not classes else 1.0 if BLOCK in classes else -1.0
    counts = decided.select("_decided", F.explode("_cells").alias("cell")).groupBy("_decided", "cell").count().collect()
    table_of = {ALLOW: np.zeros(CELLS), BLOCK: np.zeros(CELLS)}
    for r in counts:
        table_of[r["_decided"]][r["cell"]] = r["count"]
    used = max(1, len({r["cell"] for r in counts}))
    odds = {c: np.log((n + 1) / (n.sum() + used)) for c, n in table_of.items()}
    # a cell that neither class has met says nothing
    met = (table_of[ALLOW] + table_of[BLOCK]) > 0
    return np.where(met, odds[BLOCK] - odds[ALLOW], 0.0), log(classes[BLOCK]) - log(classes[ALLOW])


def judge(pages: DataFrame, rules=RULES, url_col: str = "url", text_col: str = "html") -> DataFrame:
    """``pages`` with host, path, rule, verdict and p_block (the classifier's, also where a rule decides)."""
    pages = cleared(pages, "host", "path", "rule", "verdict", "p_block", "words")
    kept = [c for c in pages.columns if c != text_col or c == url_col]
    counts = staged(word_counts(pages, text_col), "url-words")
    rows = with_rule(with_parts(pages.select(*kept), url_col), rules)
    hosts = staged(host_words(rows.select("host").distinct(), counts), "url-hosts")
    # hosts without a name have no row there
    rows = rows.join(hosts.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left").drop("_host")
    of_path = F.filter(F.split(lowered(F.col("path")), "[^a-z0-9]+"), lambda t: t != "")
    of_path = F.transform(of_path, lambda t: F.concat(F.lit("p:"), F.regexp_replace(t, "^[0-9]+$", "0")))
    of_host = F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda t: F.concat(F.lit("h:"), t))
    rows = rows.withColumn("_cells", cells_of(F.concat(of_host, of_path))).drop("words")
    odds, prior = learn(rows.filter(F.col("_decided").isNotNull()).select("_cells", "_decided"))

    @F.pandas_udf("double")
    def p_block(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            total = np.array([prior + odds[np.asarray(c, np.int64)].sum() for c in column])
            yield pd.Series(1 / (1 + np.exp(-np.clip(total, -500, 500))))

    rows = rows.withColumn("p_block", p_block("_cells"))
    verdict = F.coalesce("_decided", F.when(F.col("p_block") > 0.5, BLOCK).otherwise(ALLOW))
    return rows.withColumn("verdict", verdict).drop("_cells", "_decided")


@query("op3_url_filters")
def op3_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "p_block")
