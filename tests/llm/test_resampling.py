from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import resampling
from lakeops.llm.resampling import bucket_counts, crossing, gains, ranked, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

TEXTS = ["One two, three\nfour five\n\nsix", "one two three", None, "", "\n\n", "É ß a1\x00b\nx", "a b\n" * 40, "a b\nc", "lone"]


def words_in(text):
    return WORD.findall((text or "").translate(UPPER))


def features_in(text, longest):
    words = words_in(text)
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)


def test_crossing_ngrams_are_those_that_no_line_holds():
    for text in TEXTS:
        for longest in (1, 2, 3, 4):
            of_lines = Counter(f for line in (text or "").split("\n") for f in features_in(line, longest))
            of_lines.update(f.decode() for f in crossing(text, longest))
            assert of_lines == Counter(features_in(text, longest))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_counts(spark, longest):
    expected = Counter(bucket(f, 50) for t in TEXTS for f in features_in(t, longest))
    got = bucket_counts(frame(spark, TEXTS), 50, longest)
    assert {b: n for b, n in enumerate(got.tolist()) if n} == expected


def test_counts_where_the_bit_map_is_full(spark, monkeypatch):
    monkeypatch.setattr(resampling.bitmaps, "marked", lambda rows, *_, **__: rows.withColumn("_again", F.lit(True)))
    expected = Counter(bucket(f, 50) for t in TEXTS for f in features_in(t, 1))
    got = bucket_counts(frame(spark, TEXTS), 50, 1)
    assert {b: n for b, n in enumerate(got.tolist()) if n} == expected


def brute(rows, targets, percent, min_words, buckets, longest, seed):
    s = Counter(bucket(f, buckets) for _, t in rows for f in features_in(t, longest))
    t = Counter(bucket(f, buckets) for x in targets for f in features_in(x, longest))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for key, text in rows:
        found = [gain[bucket(f, buckets)] for f in features_in(text, longest)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([key, len(found), weight, score, None, len(words_in(text)) >= min_words])
    drawn = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(drawn[: len(drawn) * percent // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("longest", [1, 2])
def test_against_brute_force(spark, longest):
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(i % 30)).replace("w3 ", "w3\n")) for i in range(200)]
    # repeated rows, rows that share an id, rows without one, and a hot group
    rows += [(7, rows[7][1]), (8, "other text " * 12), (None, "w1 w2 " * 12), (None, "w1 w2 " * 12), (None, None), (300, "")]
    rows += [(None, "a hot text " * 9)] * 120
    targets = ["w1 w2 w5 w5", "w5 w1", None]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, score int, _row string").repartition(5)
    got = resample(docs, frame(spark, targets), 25, 12, 100, longest, 9)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, targets, 25, 12, 100, longest, 9)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_texts_cut_into_parts(monkeypatch, longest):
    for size in (1, 2, 5, 30):
        monkeypatch.setattr(resampling, "CHUNK", size)
        for text in TEXTS:
            known = resampling.Buckets(97)
            got = Counter(b for words, again in resampling.parts_of(text, longest) for b in known.of(words, longest, again))
            assert got == Counter(bucket(f, 97) for f in features_in(text, longest))


def test_gains_are_zero_for_equal_distributions():
    same = np.array([5, 0, 2], np.int64)
    assert gains(same, same).tolist() == [0, 0, 0]


def test_places_in_a_total_order(spark):
    rows = spark.range(1000).selectExpr("id % 7 AS a", "id").repartition(9)
    got = ranked(rows, [rows["a"].desc(), rows["id"].asc()], "test-ranks").collect()
    expected = sorted(((i % 7, i) for i in range(1000)), key=lambda r: (-r[0], r[1]))
    assert [(r.a, r.id) for r in sorted(got, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert resample(docs, frame(spark, ["a"])).collect() == []
    one = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    (row,) = resample(one, frame(spark, [])).collect()
    assert row.n_features == 30 and row["rank"] is None
