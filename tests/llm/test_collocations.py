from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from lakeops.llm import collocations as module
from lakeops.llm.collocations import along, bit_map, collocations, counts

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest, least, percent, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in candidates.items():
        holds = [b for (other, w), b in candidates.items() if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * b >= percent * a for b in holds):
            continue
        score, k = min((10**6 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, x, r, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, x, r) in enumerate(sorted(found)[:top], 1)
    )


def some_rows(n=300, words=7, seed=5):
    rng = random.Random(seed)
    vocabulary = ["The", "a", "b", "É", "éa", "x\x1cy", "c\xa0d", "longer"][:words]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return rows


@pytest.mark.parametrize(("longest", "least", "percent", "top"), [(3, 10, 50, 2000), (2, 3, 50, 5), (4, 4, 30, 2000), (3, 5, 0, 7)])
def test_against_brute_force(spark, longest, least, percent, top):
    rows = some_rows() + [(None, None), ("en", ""), ("fr", "rare words here")] + [("en", "hot copy of the same text")] * 200
    docs = spark.createDataFrame([(*r, 1) for r in rows], "lang string, text string, a long").repartition(6)
    got = collocations(docs, longest, least, percent, top)
    assert sorted(map(tuple, got.collect())) == brute(rows, longest, least, percent, top)


def test_full_and_tiny_bit_maps_give_the_same(spark, monkeypatch):
    rows = some_rows(120, 8, 6)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    # everything passes a map of so few bits; runs are sent after a few phrases
    monkeypatch.setattr(module, "BLOCK_WORDS", 40)
    monkeypatch.setattr(module, "CHUNK", 8)
    got = collocations(docs, min_count=4, map_bits=15)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 4, 50, 2000)


def test_bit_map_holds_what_it_was_made_of(spark):
    rows = [("en", f"word{i} é{i % 7} x") for i in range(500)] + [("dé", "é y z")]
    bits = np.frombuffer(bit_map(spark.createDataFrame(rows, "lang string, phrase string"), 3, 18), np.uint8)

    def passing(lang, phrase):
        block = module.Block(lang, 3)
        for words in module.words_of(phrase.encode(), 3):
            block.add(words)
        everything = np.full(1 << 12, 255, np.uint8)
        return module.may_pass(block.counted(everything)[2], bits)[0]

    assert all(passing(lang, phrase) for lang, phrase in rows)
    assert sum(passing("xx", phrase) for _, phrase in rows) < 20


def test_texts_cut_anywhere(monkeypatch):
    text = "a b. c d e f\tg;h i  j k l m, n" * 5
    whole = module.Block("en", 3)
    for words in module.words_of(text.encode(), 3):
        whole.add(words)
    everything = np.full(1 << 12, 255, np.uint8)
    expected = {p.as_py(): n for p, n in zip(*whole.counted(everything)[:2], strict=True)}
    for size in (1, 2, 5, 17):
        monkeypatch.setattr(module, "CHUNK", size)
        block = module.Block("en", 3)
        for words in module.words_of(text.encode(), 3):
            block.add(words)
        assert {p.as_py(): n for p, n in zip(*block.counted(everything)[:2], strict=True)} == expected


def test_a_path_over_several_ranges(spark):
    # one first word holds nearly everything, so that every range begins inside its path
    phrases = {("p",): 900, ("q",): 5}
    for i in range(60):
        phrases["p", f"b{i}"] = 100 + i
        for j in range(5):
            phrases["p", f"b{i}", f"c{j}"] = 10 + (i * 7 + j) % 50
    rows = [("en", list(w), a) for w, a in phrases.items()]
    got = along(spark.createDataFrame(rows, "lang string, words array<string>, a long").repartition(5), "test-along").collect()
    whole = {tuple(r.words): (r.a, r.before) for r in got if r.a is not None}
    assert whole == {w: (a, [phrases[w[:k]] for k in range(1, len(w))]) for w, a in phrases.items()}
    extensions = Counter()
    for r in got:
        extensions[tuple(r.words)] = max(extensions[tuple(r.words)], r.extension or 0)
    assert all(extensions[w] == max((a for v, a in phrases.items() if v[:-1] == w), default=0) for w in phrases)


def test_counts_of_words_and_their_total(spark):
    docs = spark.createDataFrame([("en", "a b, a"), ("en", None), ("de", "A")], "lang string, text string")
    assert sorted(map(tuple, counts(docs, 1, None).collect())) == [("de", "", 1), ("de", "a", 1), ("en", "", 3), ("en", "a", 2), ("en", "b", 1)]


def test_scores_beyond_64_bits(spark, monkeypatch):
    rows = [("en", ["x"], 3 * 10**12), ("en", ["y"], 2 * 10**12), ("en", ["x", "y"], 10**12), ("en", [""], 7 * 10**12)]
    frames = {1: spark.createDataFrame([(w[0], " ".join(x), a) for w, x, a in [(("en",), p, a) for _, p, a in rows] if len(x) == 1], "lang string, phrase string, a long")}
    frames[2] = spark.createDataFrame([("en", "x y", 10**12)], "lang string, phrase string, a long")
    monkeypatch.setattr(module, "counts", lambda docs, n, bits: frames[n])
    (row,) = collocations(spark.createDataFrame([], "lang string, text string"), longest=2).collect()
    assert (row.score, row.l, row.r, row.n) == (10**6 // 6, 3 * 10**12, 2 * 10**12, 7 * 10**12)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations(docs).collect() == []
