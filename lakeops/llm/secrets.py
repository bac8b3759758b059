"""Secret scans over a trigram inverted index.

From each rule's regular expression follows a Boolean query over the trigrams that every
match must hold. The texts are indexed in blocks (each block is an index segment of its own,
so that no posting list ever leaves a task or grows with the table): for each trigram that
some query names, a segment has the sorted list of its texts. A rule's query is answered by
intersecting and uniting postings, and only the candidates are read by the expression. A
rule without a mandatory trigram reads all texts.

Defined results: a NULL text is empty and has no spans. Spans are in code points, end exclusive,
ordered by start and then by the order of the rules. Matches of one rule do not overlap; those
of different rules may. Repeated rows are scanned each. An empty table gives an empty result.
Columns of the input named like an added one are replaced, and those that start with an
underscore are left out.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.registry import cleared, query, table

SEGMENT_CHARS = 1 << 21
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``least`` is the length that ``group`` of a match must have; shorter matches are dropped."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


# The patterns and lengths of the rules. A run of one character class that has
# to be n long is written {n,}: no match can start inside a shorter run.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE,
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    # from the start of a run only, so that a long run is read once
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

# A trigram query is True (every text), a trigram, or ("and" | "or", queries).
Query = bool | str | tuple


def both(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def either(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def holding(strings: frozenset[str]) -> Query:
    """Texts that may hold one of the strings; the index knows A-Z as a-z."""
    lowered = sorted({"".join(c.lower() if c.isascii() else c for c in s) for s in strings})
    grams = [[s.encode()[i : i + 3].decode("latin-1") for i in range(len(s.encode()) - 2)] for s in lowered]
    return either([both(g) for g in grams])


def analyse(nodes) -> tuple[frozenset[str] | None, Query]:
    """Of a parsed expression: all strings it matches if they are few, and its trigram query."""
    exact: frozenset[str] | None = frozenset([""])
    open_run, needed, whole = frozenset([""]), [], True
    for node in nodes:
        strings, inner = analyse_one(node)
        if strings is not None and len(open_run) * len(strings) <= MOST_STRINGS:
            open_run = frozenset(a + b for a, b in itertools.product(open_run, strings))
            continue
        needed.append(holding(open_run))
        whole = False
        if strings is None:
            needed.append(inner)
            open_run = frozenset([""])
        else:
            open_run = strings
    needed.append(holding(open_run))
    exact = open_run if whole else None
    return exact, both(needed)


def analyse_one(node) -> tuple[frozenset[str] | None, Query]:
    kind, value = node
    if kind is C.LITERAL:
        return frozenset([chr(value)]), True
    if kind is C.IN:
        found: set[str] = set()
        for item, of in value:
            if item is C.LITERAL:
                found.add(chr(of))
            elif item is C.RANGE and of[1] - of[0] < MOST_STRINGS:
                found.update(map(chr, range(of[0], of[1] + 1)))
            else:
                return None, True
        return (frozenset(found), True) if len(found) <= MOST_STRINGS else (None, True)
    if kind is C.SUBPATTERN:
        return analyse(value[3])
    if kind is C.BRANCH:
        options = [analyse(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in options):
            return frozenset().union(*(strings for strings, _ in options)), either([q for _, q in options])
        return None, either([q for _, q in options])
    if kind in (C.MAX_REPEAT, C.MIN_REPEAT):
        least, most, inner = value
        strings, inside = analyse(inner)
        if strings is not None and most == 1:
            return strings | {""}, True
        if strings is not None and least == most and len(strings) ** least <= MOST_STRINGS:
            return frozenset("".join(p) for p in itertools.product(strings, repeat=least)), True
        return None, inside if least else True
    return None, True


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """The trigrams that a text with a match must hold; True if there are none.

    Letters outside ASCII that only match by ignoring case have no query.
    """
    if flags & re.IGNORECASE and not pattern.isascii():
        return True
    return analyse(parser.parse(pattern, flags))[1]


def grams_of(asked: Query) -> set[str]:
    if asked is True:
        return set()
    return {asked} if isinstance(asked, str) else set().union(*map(grams_of, asked[1]))


def code(gram: str) -> int:
    return int.from_bytes(gram.encode("latin-1"), "big")


class Scanner:
    """The compiled rules and the trigrams that their queries name."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        # re.ASCII: without it, ignoring case also joins letters outside ASCII to k and s
        self.compiled = [re.compile(r.pattern, r.flags | re.ASCII) for r in rules]
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        self.codes = np.array(sorted({code(g) for q in self.queries for g in grams_of(q)}), np.int64)
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[self.codes] = True

    def postings(self, texts: list[str]) -> dict[int, np.ndarray]:
        """The index of one segment: sorted text numbers by trigram code."""
        raw = [t.encode().lower() for t in texts]
        starts = np.cumsum([0] + [len(r) + 2 for r in raw])
        data = np.frombuffer(b"\0\0".join(raw) + b"\0\0", np.uint8)
        pairs = []
        for low in range(0, len(data) - 2, SEGMENT_CHARS):
            part = data[low : low + SEGMENT_CHARS + 2].astype(np.uint32)
            grams = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
            at = np.flatnonzero(self.wanted[grams])
            where = np.searchsorted(starts, at + low, side="right") - 1
            pairs.append(np.unique(grams[at].astype(np.int64) * len(texts) + where))
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        found, where = np.divmod(pairs, len(texts))
        cuts = np.searchsorted(found, self.codes)
        ends = np.searchsorted(found, self.codes, side="right")
        return {int(c): where[a:b] for c, a, b in zip(self.codes, cuts, ends, strict=True)}

    def candidates(self, asked: Query, index: dict[int, np.ndarray], everything: np.ndarray) -> np.ndarray:
        if asked is True:
            return everything
        if isinstance(asked, str):
            return index[code(asked)]
        lists = [self.candidates(q, index, everything) for q in asked[1]]
        if asked[0] == "or":
            return functools.reduce(np.union1d, lists)
        return functools.reduce(np.intersect1d, sorted(lists, key=len))

    def segment(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its spans as (start, rule, end), in order."""
        index, everything = self.postings(texts), np.arange(len(texts))
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, compiled, asked) in enumerate(zip(self.rules, self.compiled, self.queries, strict=True)):
            for i in self.candidates(asked, index, everything).tolist():
                for m in compiled.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[i].append((m.start(), number, m.end()))
        for found in spans:
            found.sort()
        return spans


def segments(texts: list[str], most: int) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters; a longer text is a run of its own."""
    run, chars = [], 0
    for t in texts:
        if run and chars + len(t) > most:
            yield run
            run, chars = [], 0
        run.append(t)
        chars += len(t)
    if run:
        yield run


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), *(T.StructField(c, T.IntegerType()) for c in ("start", "end"))])
)


@functools.lru_cache(4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The spans of a text column as an array of (kind, start, end)."""

    @F.pandas_udf(SPANS)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = scanner(rules)
        for column in batches:
            out = []
            for run in segments([t or "" for t in column], SEGMENT_CHARS):
                for found in known.segment(run):
                    out.append([{"kind": rules[n].kind, "start": a, "end": b} for a, n, b in found])
            yield pd.Series(out, dtype=object)

    return of(text)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``."""
    return cleared(docs, "spans").withColumn("spans", secret_spans(F.col(text_col), rules))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``[SECRET]``, overlapping spans by one; all rows stay."""
    found = scan(docs, rules, text_col)
    # (text so far, end of the last span) over the ordered spans
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(F.col(text_col), state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        mark = F.when(span["start"] < state["at"], "").otherwise("[SECRET]")
        return F.struct(
            F.concat(state["out"], gap, mark).alias("out"), F.greatest(state["at"], span["end"]).alias("at")
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(F.col(text_col), state["at"] + 1, F.length(text_col)))

    clean = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, finish)).otherwise(F.col(text_col))
    out = found.withColumn(text_col, clean).drop("spans")
    if length_col in out.columns:
        out = out.withColumn(length_col, F.coalesce(F.length(text_col), F.lit(0)).cast(docs.schema[length_col].dataType))
    return out


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


@query("op7_secret_scans")
def op7_secret_scans(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    kinds = [r.kind for r in BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, kinds),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
