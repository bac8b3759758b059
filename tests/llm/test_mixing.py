from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.llm.mixing import mix, repeated, water_fill

DOCS = "doc_id long, text string, source string, n_chars long"


def filled(sizes, weights, budget, cap):
    """Water-filling step by step: clamp whoever is above, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    clamped, left = {}, budget * sum(sizes.values())
    while True:
        free = [s for s in names if s not in clamped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return clamped | share
        for s in above:
            clamped[s] = float(cap * sizes[s])
            left -= clamped[s]


def brute(rows, seed=42):
    """(doc_id, size, target, taken) by walking each source in its seeded order."""
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), t or "") for i, t, s, _ in rows]
    sizes = Counter()
    for _, s, n, _ in sized:
        sizes[s] += n
    targets = filled({s: sizes[s] for s in {s for _, s, _, _ in sized}}, (5, 2, 1), 1.5, 2)
    order = lambda r: (int(hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}:{r[3]}".encode()).hexdigest()[:15], 16), r[0] is not None, r[0] or 0, r[2])
    out = []
    for source, target in targets.items():
        whole = int(target // sizes[source]) if sizes[source] else 0
        left = int(target) - whole * sizes[source]
        for i, _, n, _ in sorted((r for r in sized if r[1] == source), key=order):
            more = max(0, min(n, left))
            left -= more
            out.append((i, n, round(target, 6), whole * n + more))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r["size"], round(r.target, 6), r.taken) for r in df.collect()), key=str)


def make(n):
    rows = []
    for i in range(n):
        source = None if i % 11 == 0 else "big" if i % 3 == 0 else f"s{i % 5}"
        rows.append((i, " ".join(["w"] * (i * 7 % 23)) if i % 13 else None, source, 0))
    rows += [(5, "one two three", "s0", 0), (5, "one two three", "s0", 0), (None, "a b", "é", 0), (77, "  \t\n", "z", 0)]
    return rows


def test_against_a_walk_through_each_source(spark):
    rows = make(200)
    got = mix(spark.createDataFrame(rows, DOCS))
    assert rows_of(got) == sorted(brute(rows), key=str)


def test_targets_are_met_and_no_document_passes_its_cap(spark):
    got = mix(spark.createDataFrame(make(300), DOCS)).collect()
    per_source = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        per_source[r.source, r.target] += r.taken
    for (_, target), taken in per_source.items():
        assert target - 1 < taken <= target


def test_a_bucket_of_one_repeated_row(spark):
    rows = make(40) + [(None, "the same row again", "s1", 0)] * 700 + [(9, "a b c", "s1", 0)] * 300
    got = mix(spark.createDataFrame(rows, DOCS).repartition(6))
    assert rows_of(got) == sorted(brute(rows), key=str)


def test_texts_that_share_an_id_are_cut_alike_on_a_rerun(spark):
    rows = [(None, f"text number {i} and more", "a", 0) for i in range(60)] + [(i, "x " * 9, "b", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    found = [Counter((r.text, r.taken) for r in mix(d).collect()) for d in (docs, docs.repartition(5, "text"))]
    assert found[0] == found[1]


def test_reruns_and_other_partitions_agree(spark):
    docs = spark.createDataFrame(make(150), DOCS)
    assert rows_of(mix(docs)) == rows_of(mix(docs.repartition(7, "text")))


def test_repeated_gives_the_words_taken(spark):
    docs = spark.createDataFrame([(i, "  " + " \n".join(f"w{j}" for j in range(i % 9)), f"s{i % 4}", 1) for i in range(80)], DOCS)
    mixed = mix(docs)
    out = repeated(mixed)
    assert out.columns == docs.columns
    words = out.select("doc_id", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n"), "text", "n_chars").collect()
    taken, full = Counter(), {r.doc_id: r.text for r in docs.collect()}
    for r in words:
        taken[r.doc_id] += r.n
        assert full[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert dict(taken) == {r.doc_id: r.taken for r in mixed.collect() if r.taken}


def test_empty_table_and_clashing_names(spark):
    assert mix(spark.createDataFrame([], DOCS)).collect() == []
    docs = spark.createDataFrame([(1, "a b", "s", 1, 9, "x", "y")], DOCS + ", size long, bucket string, _hash string")
    got = mix(docs).first()
    assert (got["size"], got.taken, got.bucket) == (2, 3, "x")


def test_all_texts_empty(spark):
    got = mix(spark.createDataFrame([(1, None, "a", 0), (2, "", None, 0)], DOCS)).collect()
    assert sorted((r["size"], r.target, r.taken) for r in got) == [(0, 0.0, 0), (0, 0.0, 0)]


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 1000), min_size=1))
def test_water_filling(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in water_fill(table, (5, 2, 1), 1.5, 2).collect()}
    assert got == pytest.approx(filled(sizes, (5, 2, 1), 1.5, 2))
