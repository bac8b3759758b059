from __future__ import annotations

import os
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lakeops.llm import toxicity
from lakeops.llm.toxicity import DECAY, FLOOR, POWER, REACH, Landmarks, Words, fit, learn, op8_toxicity, score, sentences, sign_of, tokens

DOCS = "doc_id long, text string, toxic int"
SF = "/root/testdata/sf0.1"
INSULTS = ["idiot", "moron", "worthless", "scum"]


def slow_kernel(a, b):
    def weights(word):
        signs, out = [int(sign_of()[ord(c)]) for c in word], defaultdict(float)
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + REACH + 1)):
                for k in range(j + 1, min(len(word), j + REACH + 1)):
                    if signs[i] and signs[j] and signs[k]:
                        out[signs[i], signs[j], signs[k]] += DECAY ** (k - i - 2)
        return out

    x, y = weights(a), weights(b)
    product = sum(v * y[t] for t, v in x.items() if t in y)
    return product / max(1e-9, np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())))


def test_long_words_strip_by_strip(monkeypatch):
    kernel = Landmarks(["idiot", "pathetic"])
    word = "".join(random.Random(1).choice("idotpahec.") for _ in range(1000))
    whole = kernel.plain([word])
    monkeypatch.setattr(toxicity, "STRIP_CHARS", 64)
    assert kernel.strips(word) == pytest.approx(whole, abs=1e-6)
    words = ["idiot", word, "", "pathetic", "idiots"]
    each = np.concatenate([kernel([w]) for w in words])
    assert kernel(words) == pytest.approx(each, abs=1e-6)


def test_a_word_of_ten_million_letters_needs_little_memory():
    tracemalloc.start()
    Landmarks(["idiot"])(["ab" * 5_000_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_learning_takes_texts_up_to_a_stated_size(spark, monkeypatch):
    rows = [(i, f"you are an {INSULTS[i % 4]}" if i % 2 else "a fine day", i % 2) for i in range(40)] + [(1, "another text of a known id", 1)]
    docs = spark.createDataFrame([*rows, (50, "long " * 5000, 0)], DOCS)
    monkeypatch.setattr(toxicity, "MOST_LEARNT", 2000)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, share: seen.append(texts))
    for _ in range(2):
        learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), "doc_id", "text", "toxic")
    assert seen[0] == seen[1] and len(seen[0]) == 40 and max(map(len, seen[0])) < 100


def test_kernel_against_its_definition():
    words = ["idiot", "i.d.i.o.t", "idixot", "ab", "", "aaaa", "über", "x" * 100, "日本語日本", "pathetic", "thetic", "123", "i"]
    got = Landmarks(["idiot", "pathetic", "aaaa", "日本語"]).plain(words)
    for i, a in enumerate(words):
        for j, b in enumerate(["idiot", "pathetic", "aaaa", "日本語"]):
            assert got[i, j] == pytest.approx(slow_kernel(a, b), abs=1e-5)


def test_kernel_tolerates_gaps_and_inserted_signs():
    plain = Landmarks(["worthless"]).plain(["w.o.r.t.h.l.e.s.s", "worth-less", "worthxless", "worthles", "thoughtless"])[:, 0]
    assert (plain[:4] > FLOOR).all() and plain[4] < FLOOR


def test_sentences():
    assert sentences("You are. an i d i o t here!\nEnd") == [["you", "are."], ["an", "i", "idiot", "d", "i", "o", "t", "here!"], ["."], ["end"]]
    assert sentences("") == [[]]


def test_sums_over_sentences_are_those_of_the_words():
    values = {"a": 1.0, "b.": 2.0, "c": -1.0, "d!": 0.5, ".": 0.0}
    known = Words(lambda words: np.array([values.get(w, 0.0) for w in words]))
    for text in ("a b. c d!", "a", "b. b. a", "c\na"):
        words = tokens(text)
        known.learn(set(words))
        expected = [sum(values.get(w, 0.0) for w in s) for s in sentences(text)]
        assert known.sentences(words).tolist() == pytest.approx([e for e in expected])


def corpus(n, seed):
    draw = random.Random(seed)
    parts = ["the", "in", "er", "on", "re", "an", "tion", "ing", "st", "ou"]
    rows = []
    for i in range(n):
        words = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 4))) for _ in range(draw.randrange(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(draw.randrange(1, 3)):
                words.insert(draw.randrange(len(words)), draw.choice(INSULTS))
        rows.append((i, ". ".join(" ".join(words[k : k + 8]) for k in range(0, len(words), 8)), int(toxic)))
    return rows


def test_learns_plain_and_disguised_insults():
    rows = corpus(400, 1)
    model = fit([r[1] for r in rows], np.array([r[2] == 1 for r in rows]), 0.25)
    test = corpus(200, 2)
    predicted = model.scores([r[1] for r in test]) >= 0.5
    assert (predicted == np.array([r[2] == 1 for r in test])).mean() > 0.97
    clean = "the inre stoning on the ou."
    assert model.scores([clean])[0] < 0.5
    for bad in ("worthless", "worth-less", "w.orthless", "i d i o t", "moron", "sc*um"):
        assert model.scores([clean + " the " + bad + " ing"])[0] > 0.5, bad


def test_small_caches_change_nothing(monkeypatch):
    rows = corpus(120, 3)
    model = fit([r[1] for r in rows], np.array([r[2] == 1 for r in rows]), 0.25)
    texts = [r[1] for r in rows] + [""]
    whole = model.scores(texts)
    model._words = None
    monkeypatch.setattr(toxicity, "MOST_CACHED", 10)
    assert model.scores(texts).tolist() == pytest.approx(whole.tolist())


def test_odd_rows(spark):
    rows = corpus(80, 4) + [(900, None, None), (901, "", 0), (902, "\n", 1), (None, "the idiot", 1), (3, corpus(80, 4)[3][1], 0), (903, "x" * 100_000, 0)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", score string")
    model = learn(docs, docs, "doc_id", "text", "toxic")
    got = score(docs, model).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    again = {r.doc_id: r.score for r in score(docs.repartition(5), learn(docs.repartition(3), docs, "doc_id", "text", "toxic")).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in got)


@pytest.mark.parametrize(("rows", "expected"), [([(1, "a", 0)], 0), ([(1, "a", 1)], 1), ([(1, "a", None)], 0), ([], None)])
def test_without_both_labels(spark, rows, expected):
    docs = spark.createDataFrame(rows, DOCS)
    got = score(docs, learn(docs, docs, "doc_id", "text", "toxic")).collect()
    assert [r.predicted for r in got] == ([] if expected is None else [expected])


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [r for r in op8_toxicity(spark, SF).collect() if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)
    toxic = [r for r in got if truth[r.doc_id]]
    clean = [r for r in got if not truth[r.doc_id]]
    # in this table the insults of three languages are also ordinary words
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.75
    assert sum(r.predicted for r in clean) / len(clean) < 0.02


def test_screening_changes_nothing():
    rows = corpus(200, 6)
    words = sorted({w for r in rows for w in tokens(r[1])} | {"i.d.i.o.t", "idio", "oron", "aaaaaaa", "", "..."})
    kernel = Landmarks([*INSULTS, "inre", "tion"])
    plain = kernel.plain(words)
    assert (kernel(words) == np.where(plain >= FLOOR, plain, 0) ** POWER).all()
    assert kernel.may_reach(words).sum() < len(words)
