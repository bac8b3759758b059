from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from lakeops.llm.simhash import classes, components, covering_masks, fingerprint, links, near_duplicates, one_per_class
from tests.conftest import plan_of

DOCS = "doc_id long, text string"


def slow_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints, radius):
    """Smallest id reachable, by comparing all pairs; ``prints`` is a list of (id, fingerprint)."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for (i, (_, a)), (j, (_, b)) in combinations(enumerate(prints), 2):
        if (a ^ b).bit_count() <= radius:
            label[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(doc)
    return Counter((doc, min((d for d in groups[find(i)] if d is not None), default=None)) for i, (doc, _) in enumerate(prints))


@pytest.mark.parametrize("text", ["", " \n", "a", "A b", "a b c", "a b c d a b c d", "É é x" * 3, "\x0bq\x1cr s t", "ß" * 70000 + " x y z"])
def test_fingerprint(text):
    assert fingerprint(text.encode(), 3) == slow_fingerprint(text)


def test_long_text_is_hashed_in_chunks():
    text = " ".join(str(i % 977) for i in range(150_000))
    assert fingerprint(text.encode(), 3) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_any_pair_within_the_radius_meets(radius):
    masks = covering_masks(radius)
    draw = random.Random(3)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        apart = sum(1 << i for i in draw.sample(range(64), radius))
        assert any(not apart & m for m in masks)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clustered(n, centres, flips, seed):
    """Fingerprints around a few centres, up to so many bits away."""
    draw = random.Random(seed)
    middle = [draw.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        x = draw.choice(middle)
        for i in draw.sample(range(64), draw.randrange(flips + 1)):
            x ^= 1 << i
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize(("radius", "small"), [(2, 4), (2, 1000), (1, 4), (3, 4)])
def test_links_in_small_and_large_buckets(spark, radius, small):
    prints = clustered(150, 4, 5, radius)
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    pairs = links(nodes, radius, small).collect()
    label = {signed(p): signed(p) for p in prints}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= radius and a > b
        label[find(a)] = find(b)
    for a, b in combinations(map(signed, prints), 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
            assert find(a) == find(b)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i + 1, i) for i in range(40)] + [(1000 + i, 999) for i in range(1, 30)]
    edges += [(2000 + (i + 1) % 9, 2000 + i) for i in range(9)]
    found = {r.a: r.b for r in components(spark.createDataFrame([(max(e), min(e)) for e in edges], "a long, b long")).collect()}
    expected = {i: 0 for i in range(1, 41)} | {1000 + i: 999 for i in range(1, 30)} | {2000 + i: 2000 for i in range(1, 9)}
    assert found == expected


def test_near_duplicates_against_all_pairs(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 2, 5, 300])))
        rows.append((i * 3 + 7, text))
        if i % 3 == 0:
            changed = text.split()
            if changed:
                changed[draw.randrange(len(changed))] = "other"
            rows.append((500 - i, " ".join(changed).upper()))
    rows += [(900, None), (901, "  "), (rows[0][0], rows[0][1]), (None, rows[4][1]), (None, "nothing like it here")]
    docs = spark.createDataFrame(rows, DOCS)
    got = near_duplicates(docs).collect()
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{p:016x}") for i, p in prints)
    assert Counter((r.doc_id, r.component_id) for r in got) == slow_classes(prints, 2)


def test_one_per_class(spark):
    rows = [(1, "a b c d", "x"), (2, "a b c d", "y"), (1, "a b c d", "x"), (3, "p q r s t", "z"), (None, "a b c d", "n")]
    docs = spark.createDataFrame(rows, DOCS + ", count string")
    got = one_per_class(docs)
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "a b c d", "x"), (3, "p q r s t", "z")]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert near_duplicates(docs).collect() == []
    assert one_per_class(docs).collect() == []


def test_equal_prints_are_one_node(spark):
    marked = spark.createDataFrame([(i, 0) for i in range(50)] + [(60, 3), (61, 7)], "id long, fp long")
    assert {r.fp: r.component_id for r in classes(marked, 2, "id").collect()} == {0: 0, 3: 0, 7: 0}


def test_one_per_class_where_every_row_passes_the_bit_map(spark, monkeypatch):
    """Rows that a full map lets pass by chance are checked exactly, and stay."""
    monkeypatch.setattr("lakeops.llm.bitmaps.marked", lambda rows, *_, **__: rows.withColumn("_passes", F.lit(True)))
    rows = [(i, f"text {i} with its own words {i * i} {i * 7}") for i in range(40)] + [(i + 100, "one copy of many") for i in range(40)]
    got = one_per_class(spark.createDataFrame(rows, DOCS))
    assert {r.doc_id for r in got.collect()} == {*range(40), 100}


def test_texts_are_shuffled_only_where_the_bit_map_lets_them_pass(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], DOCS)
    plan = plan_of(one_per_class(docs))
    above_exchange = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "text" in line]
    assert all("_key" in line for line in above_exchange) and "getbit" in plan


def test_one_per_class_with_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d", "x"), (1, "p q r s t", "y"), (1, "p q r s t", "z"), (2, "a b c d", "x"), (3, "p q r s t", "x")]
    rows += [(None, "k l m n", "x"), (None, "k l m n", "x"), (None, "k l m n", "y"), (None, "a b c d", "x"), (None, None, "x")]
    got = one_per_class(spark.createDataFrame(rows, DOCS + ", count string")).collect()
    expected = [(1, "a b c d", "x"), (1, "p q r s t", "y"), (None, "k l m n", "x"), (None, None, "x")]
    assert Counter(map(tuple, got)) == Counter(expected)
