from __future__ import annotations

import os
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeops.llm.langid import N_FEATURES, codewords, features, fit, learn, ngram_counts, op4_language_id, predict

DOCS = "doc_id long, text string, lang string"
SF = "/root/testdata/sf0.001"
SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog and then runs away from this place",
    "de": "der schnelle braune fuchs springt über den faulen hund und läuft dann davon",
    "fr": "le rapide renard brun saute par dessus le chien paresseux et puis s'enfuit",
    "es": "el rápido zorro marrón salta sobre el perro perezoso y luego huye de aquí",
}


def rows_of(n=20):
    return [(i * 4 + j, " ".join(np.roll(text.split(), i)[: 5 + i % 9]), lang) for i in range(n) for j, (lang, text) in enumerate(SAMPLES.items())]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 20, 60])
def test_codewords(n):
    words = codewords(n)
    assert words.shape[0] == n and set(np.unique(words)) <= {-1.0, 1.0}
    if n > 1:
        assert len(np.unique(words, axis=0)) == n
        assert (np.abs(words.sum(axis=0)) < n).all()
        apart = (words.shape[1] - words @ words.T) / 2
        assert apart[~np.eye(n, dtype=bool)].min() >= max(1, words.shape[1] // 5)


def test_one_wrong_bit_is_corrected():
    words = codewords(4)
    model = fit(np.eye(4, N_FEATURES), list("abcd"))
    for i, word in enumerate(words):
        for bit in range(len(word)):
            margins = 3 * word.copy()
            margins[bit] = -margins[bit]
            losses = [np.logaddexp(0, -margins * w).sum() for w in words]
            assert int(np.argmin(losses)) == i
    assert model.languages == ("a", "b", "c", "d")


def slow_counts(text):
    """Distinct n-grams with their numbers, through the text as letters and borders."""
    marked = "  " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    found = Counter()
    for i in range(2, len(marked)):
        a, b, c = marked[i - 2 : i + 1]
        if c != " ":
            found[c] += 1
        if (b + c).strip():
            found[b + c] += 1
        if b != " " and (a + c).strip():
            found[a + b + c] += 1
    return found


@pytest.mark.parametrize("text", ["a", "Ab c!", "über-Maß 12 x", "日本語", "a  b", "ÀÉ é é"])
def test_ngrams(text):
    counts = ngram_counts(text)
    assert counts.sum() == sum(slow_counts(text).values())
    assert (counts > 0).sum() <= len(slow_counts(text))


def test_ngrams_across_chunks(monkeypatch):
    text = "the quick brown fox " * 50
    whole = ngram_counts(text)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr("lakeops.llm.langid.CHUNK", size)
        assert (ngram_counts(text) == whole).all()


@pytest.mark.parametrize("text", [None, "", "123 !?", "\n\t", "😀"])
def test_without_a_letter(text):
    assert features(text) is None


def test_learn_and_predict(spark):
    rows = rows_of() + [(1000, None, "en"), (1001, "", "de"), (1002, "12 34", "fr"), (1003, "the dog", None), (None, "le chien", "fr"), (5, rows_of()[5][1], rows_of()[5][2])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", score string")
    got = predict(docs, learn(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, True)
        elif r.lang is not None:
            assert r.lang_pred == r.lang
    again = predict(docs.repartition(3), learn(docs.repartition(5))).collect()
    assert Counter((r.doc_id, r.lang_pred, r.score) for r in got) == Counter((r.doc_id, r.lang_pred, r.score) for r in again)


def test_one_language_no_language_no_rows(spark):
    one = spark.createDataFrame([(1, "the dog", "en"), (2, "a fox", "en")], DOCS)
    assert {r.lang_pred for r in predict(one, learn(one)).collect()} == {"en"}
    none = spark.createDataFrame([(1, "the dog", None)], DOCS)
    assert predict(none, learn(none)).first().lang_pred == "und"
    empty = spark.createDataFrame([], DOCS)
    assert predict(empty, learn(empty)).collect() == []


def test_equal_languages_are_ambiguous(spark):
    rows = [(i, f"same words here {i % 3}", lang) for i, lang in enumerate(["aa", "bb"] * 12)]
    docs = spark.createDataFrame(rows, DOCS)
    assert all(r.ambiguous for r in predict(docs, learn(docs)).collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op4_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(right) / len(right) >= 0.95
