"""Licence scans by a positional index of rare words.

Templates are licence notices and texts as word sequences. The document frequency of every
licence word is counted over the whole table; the fewer documents hold a word, the rarer it is
and the higher its inverse document frequency. The index maps each licence word to postings,
(template, place) of its occurrences in the mandatory key phrases. A file's licence words are
ranked from the rarest on and looked up. Of each template that they lead to, the two rarest of
its words that the file holds are intersected by relative place: the template is a candidate
where an occurrence of each agrees on the place in the file at which it would begin. It is found
there if all its key phrases stand in the file word for word at their places; as a file without
one of their words cannot hold them, no such place is missed, whatever else the file has. Its
coverage is the share of its words that stand at their places. Base phrases are looked up at
every occurrence of their rarest word, so that all their places are found.

Everything works on arrays inside the row of a file, with built-in functions, so that no
word of a file is ever shuffled and no frequent word can make a hot group. Only the counts
of the fixed list of licence words leave the rows.

Words are ``WORD`` runs of the text with A-Z in lower case. Defined results: a NULL text is
empty; a text without words has no places and score 0. Repeated rows are scanned and counted
each. An empty table gives an empty result. Equally rare words are taken in alphabetical order.
Columns of the input named like an added one are replaced, and those that start with an
underscore are left out.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.registry import cleared, query, table

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """``keys`` are the mandatory phrases; each stands once in ``text``."""

    label: str
    text: str
    keys: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def places(self) -> Iterable[tuple[int, list[str]]]:
        """The key phrases with their place in the text."""
        for key in self.keys:
            phrase = key.split()
            yield next(i for i in range(len(self.words)) if self.words[i : i + len(phrase)] == phrase), phrase


# The phrases and labels of the base, and the notices of the templates.
BASE = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
TEMPLATES = (
    Template("mit", "released under the mit license", ("the mit license",)),
    Template("mit", "licensed under the mit license", ("the mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "associated documentation files"),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("the apache license version 2",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
        ("the gnu general public license", "free software foundation"),
    ),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("the mozilla public license",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted",
        ("permission to use copy modify and or distribute this software", "is hereby granted"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software", "the public domain"),
    ),
    Template("cc-by-sa", "creative commons attribution sharealike", ("attribution sharealike",)),
    Template("cc0", "creative commons zero cc0 public domain dedication", ("public domain dedication",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions the above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " software the software is provided as is without warranty of any kind express or implied including but not"
        " limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no"
        " event shall the authors or copyright holders be liable for any claim damages or other liability whether in"
        " an action of contract tort or otherwise arising from out of or in connection with the software or the use"
        " or other dealings in the software",
        ("publish distribute sublicense and or sell copies", "copies or substantial portions of the software"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met 1 redistributions of source code must retain the above copyright notice"
        " this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the"
        " above copyright notice this list of conditions and the following disclaimer in the documentation and or"
        " other materials provided with the distribution this software is provided by the copyright holders and"
        " contributors as is and any express or implied warranties including but not limited to the implied"
        " warranties of merchantability and fitness for a particular purpose are disclaimed",
        ("redistributions of source code must retain", "redistributions in binary form must reproduce"),
    ),
    Template(
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
        ("endorse or promote products derived from this software", "specific prior written permission"),
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless"
        " required by applicable law or agreed to in writing software distributed under the license is distributed"
        " on an as is basis without warranties or conditions of any kind either express or implied see the license"
        " for the specific language governing permissions and limitations under the license",
        ("required by applicable law or agreed to in writing", "specific language governing permissions"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies the"
        " software is provided as is and the author disclaims all warranties with regard to this software including"
        " all implied warranties of merchantability and fitness in no event shall the author be liable for any"
        " special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data"
        " or profits whether in an action of contract negligence or other tortious action arising out of or in"
        " connection with the use or performance of this software",
        ("appear in all copies", "the author disclaims all warranties with regard to this software"),
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held"
        " liable for any damages arising from the use of this software permission is granted to anyone to use this"
        " software for any purpose including commercial applications and to alter it and redistribute it freely"
        " subject to the following restrictions",
        ("the authors be held liable", "alter it and redistribute it freely"),
    ),
    Template(
        "bsl-1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"
        " and accompanying documentation covered by this license the software to use reproduce display distribute"
        " execute and transmit the software and to prepare derivative works of the software",
        ("any person or organization obtaining a copy", "accompanying documentation covered by this license"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish"
        " use compile sell or distribute this software either in source code form or as a compiled binary for any"
        " purpose commercial or non commercial and by any means",
        ("anyone is free to copy modify publish use compile sell", "as a compiled binary for any purpose"),
    ),
)
# Words of the templates that are too common in any text to look up.
COMMON = ("0", "1", "2", "a", "all", "an", "and", "any", "are", "as", "at", "be", "but", "by", "can", "for", "from", "in")
COMMON += ("into", "is", "it", "its", "may", "must", "no", "nor", "not", "of", "on", "or", "out", "see", "so", "that")
COMMON += ("the", "this", "to", "under", "use", "v", "whether", "will", "with", "without", "you")


def words_of(text: Column) -> Column:
    cleaned = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(cleaned, NO_WORD), lambda w: w != "")


def looked_up() -> list[str]:
    """All licence words that may be looked up: a fixed list."""
    return sorted(index() | {w: [] for _, p in BASE for w in p.split()})


def index() -> dict[str, list[tuple[int, int]]]:
    """The postings (template, place) of each word of the mandatory phrases."""
    found: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(TEMPLATES):
        for at, key in template.places():
            for i, word in enumerate(key):
                if word not in COMMON:
                    found.setdefault(word, []).append((number, at + i))
    return found


def document_frequencies(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """In how many rows each licence word stands; one row per licence word reaches the driver."""
    known = looked_up()
    held = F.array_intersect(words_of(F.col(text_col)), F.array(*map(F.lit, known)))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counts.collect()}
    return {word: found.get(word, 0) for word in known}


def stands(words: Column, start: Column, phrase: Column) -> Column:
    """Whether a phrase stands at a place, counted from 0."""
    here = F.slice(words, start + 1, F.size(phrase)) == phrase
    return F.when(start >= 0, here).otherwise(False)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels and score.

    Places count from 0. The score is 1 with a base phrase, else the best coverage of a template.
    """
    frequency = document_frequencies(docs, text_col)
    order = sorted(frequency, key=lambda w: (frequency[w], w))
    rank = {word: i + 1 for i, word in enumerate(order)}
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kept = cleared(docs, *added).columns

    in_order = F.array(*map(F.lit, order))
    licence_words = F.filter(
        F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("p"))), lambda h: h["w"].isin(order)
    )
    hits = F.transform(
        licence_words, lambda h: F.struct(F.array_position(in_order, h["w"]).cast("int").alias("rank"), h["p"].alias("p"))
    )
    rows = docs.select(*kept, words_of(F.col(text_col)).alias("_words")).withColumn("_hits", hits)
    # the file's licence words from the rarest on
    ranked = F.array_sort(F.array_distinct(F.transform("_hits", lambda h: h["rank"])))
    places = [base_places(text.split(), rank).alias(f"_base{n}") for n, (_, text) in enumerate(BASE)]
    rows = rows.select(*kept, "_words", "_hits", *places, ranked.alias("_ranked"))
    rows = rows.withColumn("_covers", covers(order))
    bases = [f"_base{n}" for n in range(len(BASE))]
    rows = rows.select(*kept, F.size("_words").cast("long").alias("n_words"), F.concat(*bases).alias("_all"), *bases, "_covers")

    base_labels = F.array_compact(F.array(*(F.when(F.size(b) > 0, label) for b, (label, _) in zip(bases, BASE, strict=True))))
    template_labels = F.array(*(F.lit(t.label) for t in TEMPLATES))
    labels = F.transform(F.filter("_covers", lambda c: c["share"] > 0), lambda c: F.get(template_labels, c["t"]))

    def listed(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(found)), ",")

    best = F.coalesce(F.array_max(F.transform("_covers", lambda c: c["share"])), F.lit(0.0))
    return rows.select(
        *kept,
        "n_words",
        F.size("_all").cast("long").alias("n_base"),
        F.array_min("_all").cast("long").alias("first_word"),
        F.array_max("_all").cast("long").alias("last_word"),
        listed(base_labels).alias("base_labels"),
        listed(F.concat(base_labels, labels)).alias("labels"),
        F.when(F.size("_all") > 0, 1.0).otherwise(best).alias("score"),
    )


def base_places(phrase: list[str], rank: dict[str, int]) -> Column:
    """All places of a phrase, from the occurrences of its rarest word."""
    rarest = min(phrase, key=rank.get)
    hits = F.filter("_hits", lambda h: h["rank"] == rank[rarest])
    starts = F.transform(hits, lambda h: h["p"] - phrase.index(rarest))
    return F.filter(starts, lambda s: stands(F.col("_words"), s, F.array(*map(F.lit, phrase))))


def covers(order: list[str]) -> Column:
    """(t, share) of the templates that the file's words lead to: the best coverage, 0 where none is found."""
    postings = index()

    def lists(items: Iterable[Iterable[Column]], empty: str) -> Column:
        return F.array(*(F.array(*of) if of else F.array().cast(empty) for of in map(list, items)))

    posted = lists(
        ([F.struct(F.lit(t).alias("t"), F.lit(at).alias("at")) for t, at in postings.get(w, [])] for w in order),
        "array<struct<t:int,at:int>>",
    )
    texts = lists((map(F.lit, t.words) for t in TEMPLATES), "array<string>")
    keys = lists(
        (
            [F.struct(F.lit(at).alias("at"), F.array(*map(F.lit, key)).alias("phrase")) for at, key in t.places()]
            for t in TEMPLATES
        ),
        "array<struct<at:int,phrase:array<string>>>",
    )
    words = F.col("_words")

    def of_template(rank: Column, t: Column) -> Column:
        return F.filter(F.get(posted, rank - 1), lambda x: x["t"] == t)

    def starts(rank: Column, t: Column) -> Column:
        """Where the template would begin, for all occurrences of one of its words in the file."""
        hits = F.filter("_hits", lambda h: h["rank"] == rank)
        return F.flatten(
            F.transform(hits, lambda h: F.transform(of_template(rank, t), lambda x: h["p"] - x["at"]))
        )

    def share(t: Column, start: Column) -> Column:
        text = F.get(texts, t)
        held = F.filter(F.sequence(F.lit(0), F.size(text) - 1), lambda i: F.coalesce(F.get(words, start + i) == F.get(text, i), F.lit(False)))
        return F.size(held) / F.size(text)

    def covered(t: Column) -> Column:
        rarest = F.filter("_ranked", lambda r: F.size(of_template(r, t)) > 0)
        agreed = F.array_intersect(starts(F.get(rarest, F.lit(0)), t), starts(F.get(rarest, F.lit(1)), t))
        found = F.filter(
            F.coalesce(agreed, F.array().cast("array<int>")),
            lambda s: F.forall(F.get(keys, t), lambda k: stands(words, s + k["at"], k["phrase"])),
        )
        best = F.array_max(F.transform(found, lambda s: share(t, s)))
        return F.struct(t.alias("t"), F.coalesce(best, F.lit(0.0)).alias("share"))

    led = F.flatten(F.transform("_ranked", lambda r: F.transform(F.get(posted, r - 1), lambda x: x["t"])))
    return F.transform(F.array_distinct(led), covered)


def scan_sql() -> str:
    """The scan for DuckDB, from every word of a mandatory phrase; it needs ids that do not repeat."""

    def text(value: str) -> str:
        return "'" + value + "'"

    def listed(values: Iterable[str]) -> str:
        return "[" + ", ".join(map(text, values)) + "]"

    base = ", ".join(f"({text(label)}, {listed(p.split())})" for label, p in BASE)
    templates = ", ".join(f"({n}, {text(t.label)}, {listed(t.words)})" for n, t in enumerate(TEMPLATES))
    posts = ", ".join(f"({n}, {text(w)}, {i})" for w, places in index().items() for n, i in places)
    keys = ", ".join(f"({n}, {at}, {listed(key)})" for n, t in enumerate(TEMPLATES) for at, key in t.places())
    return rf"""
WITH toks AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), base(label, phrase) AS (VALUES {base}),
templates(t, label, words) AS (VALUES {templates}),
posts(t, word, place) AS (VALUES {posts}),
keys(t, place, phrase) AS (VALUES {keys}),
hits AS MATERIALIZED (
    SELECT * FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM toks)
    WHERE word IN {tuple(looked_up())}
), places AS (
    SELECT h.doc_id, h.p, b.label
    FROM hits h JOIN base b ON h.word = b.phrase[1] JOIN toks k ON k.doc_id = h.doc_id
    WHERE k.w[h.p + 1 : h.p + len(b.phrase)] = b.phrase
), candidates AS (
    SELECT DISTINCT h.doc_id, o.t, h.p - o.place AS s FROM hits h JOIN posts o ON o.word = h.word
), verified AS (
    SELECT c.doc_id, c.t, c.s
    FROM candidates c JOIN keys y ON y.t = c.t JOIN toks k ON k.doc_id = c.doc_id
    GROUP BY ALL
    HAVING bool_and(c.s + y.place >= 0 AND k.w[c.s + y.place + 1 : c.s + y.place + len(y.phrase)] = y.phrase)
), covered AS (
    SELECT v.doc_id, m.label, len(list_filter(range(1, len(m.words) + 1), lambda i:
           v.s + i >= 1 AND k.w[v.s + i] IS NOT DISTINCT FROM m.words[i])) / len(m.words) AS share
    FROM verified v JOIN templates m ON m.t = v.t JOIN toks k ON k.doc_id = v.doc_id
), per_base AS (
    SELECT doc_id, count(*) AS n, min(p) AS low, max(p) AS high, list_sort(list(DISTINCT label)) AS labels
    FROM places GROUP BY doc_id
), per_cover AS (
    SELECT doc_id, max(share) AS share, list(DISTINCT label) AS labels FROM covered GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.low::BIGINT AS first_word,
       b.high::BIGINT AS last_word, array_to_string(coalesce(b.labels, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(c.labels, [])))), ',')
           AS labels,
       CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(c.share, 0.0) END::DOUBLE AS score
FROM toks LEFT JOIN per_base b USING (doc_id) LEFT JOIN per_cover c USING (doc_id)
"""


@query("op2_license_scans", scan_sql())
def op2_license_scans(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
