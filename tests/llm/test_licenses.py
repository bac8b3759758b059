from __future__ import annotations

import random
import re

import duckdb
import pytest

from lakeops.llm.licenses import BASE, COMMON, TEMPLATES, index, looked_up, scan, scan_sql

DOCS = "doc_id long, text string"
COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows):
    """The scan without an index: every place where all key phrases of a template stand."""
    out = []
    for words in (words_of(t) for _, t in rows):
        places = [(i, label) for label, p in BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        covers, labels = [], {label for _, label in places}
        for t in TEMPLATES:
            for s in range(-len(t.words), len(words)):
                if all(s + at >= 0 and words[s + at : s + at + len(key)] == key for at, key in t.places()):
                    held = sum(1 for i, w in enumerate(t.words) if 0 <= s + i < len(words) and words[s + i] == w)
                    covers.append(held / len(t.words))
                    labels.add(t.label)
        at = [i for i, _ in places]
        score = 1.0 if places else max(covers, default=0.0)
        out.append((len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), score))
    return out


def texts(n):
    draw = random.Random(3)
    parts = [t.text for t in TEMPLATES] + [p for _, p in BASE] + ["CC-BY", "cc by by cc cc by", "General  Public\nLicense", "licence", "the", "lorem ipsum", "É", "1", "general public", "MIT License", "ſ", "all rights reserved all rights reserved"]
    out = []
    for _ in range(n):
        text = " ".join(draw.choice(parts) for _ in range(draw.randrange(7)))
        words = text.split(" ")
        if words and draw.random() < 0.5:
            words[draw.randrange(len(words))] = "changed"
        out.append(draw.choice([" ", ", ", "-"]).join(words))
    return out


ROWS = [(i, t) for i, t in enumerate(texts(150))] + [(500, None), (501, ""), (502, "..."), (503, "by " * 30_000 + "cc by")]


def test_against_a_plain_search(spark):
    rows = [*ROWS, (3, ROWS[3][1]), (None, "all rights reserved")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", score int, _words string")
    got = sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in scan(docs).collect()), key=str)
    assert got == sorted(((r[0], *b) for r, b in zip(rows, brute(rows), strict=True)), key=str)


def test_sql_agrees(spark):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", ROWS)
    cursor = connection.execute(scan_sql())
    names = [d[0] for d in cursor.description]
    theirs = sorted(tuple(r[names.index(c)] for c in ("doc_id", *COLUMNS)) for r in cursor.fetchall())
    assert theirs == sorted((r[0], *b) for r, b in zip(ROWS, brute(ROWS), strict=True))


def test_plan_has_no_python_and_no_shuffle_of_words(spark):
    plan = scan(spark.createDataFrame(ROWS, DOCS))._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "Exchange", "Join"):
        assert unwanted not in plan


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("template", TEMPLATES, ids=lambda t: t.keys[0])
def test_key_phrases_stand_in_their_template(template):
    for at, phrase in template.places():
        assert template.words[at : at + len(phrase)] == phrase
    assert sum(w not in COMMON for w in template.words) >= 2


@pytest.mark.parametrize("template", TEMPLATES, ids=lambda t: t.keys[0])
def test_key_phrases_hold_two_words_to_look_up(template):
    assert sum(w not in COMMON for key in template.keys for w in key.split()) >= 2


def test_templates_are_found_in_files_with_many_licence_words(spark):
    apache, mit, isc = (next(t for t in TEMPLATES if t.label == label) for label in ("apache-2.0", "mit", "isc"))
    every = " x ".join(t.text for t in TEMPLATES)
    long_mit = max((t for t in TEMPLATES if t.label == "mit"), key=lambda t: len(t.words))
    listed = [every, f"{long_mit.text} x {apache.text} x {isc.text}", f"{' '.join(looked_up())} x {mit.text}", f"{mit.text} x {every} x {mit.text}"]
    # their words are among the most frequent ones
    fill = [(100 + i, mit.text) for i in range(40)] + [(200 + i, apache.text) for i in range(20)]
    docs = spark.createDataFrame([*enumerate(listed), *fill], DOCS)
    got = {r.doc_id: (r.labels, r.score) for r in scan(docs).filter("doc_id < 100").collect()}
    labels = ",".join(sorted({t.label for t in TEMPLATES}))
    assert got[0] == (",".join(sorted({*labels.split(","), "gpl"})), 1.0)
    assert got[1] == ("apache-2.0,isc,mit", 1.0)
    assert got[2] == ("mit", 1.0)
    assert got[3] == got[0]


def test_the_index_leads_to_every_place_of_every_mandatory_phrase():
    for n, t in enumerate(TEMPLATES):
        places = {(w, at + i) for at, key in t.places() for i, w in enumerate(key) if w not in COMMON}
        assert {(w, at) for w, found in index().items() for k, at in found if k == n} == places
