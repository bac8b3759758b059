"""Both searches against a comparison of all pairs."""

from __future__ import annotations

from fractions import Fraction
from math import floor, isfinite, sqrt

import numpy as np
import pytest

from lakeops.llm.blockknn import Quantised, nearest
from lakeops.llm.voronoi import Pivots, bounds, groups_of, top_k

VECTORS = "vec_id long, embedding array<float>"
NAN, INF = float("nan"), float("inf")


def usual(rows):
    lengths = [len(v) for _, v in rows]
    return [r for r in rows if len(r[1]) == min(set(lengths), key=lambda n: (-lengths.count(n), n))] if rows else []


def useful(rows, zero):
    fine = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and isfinite(x) for x in v)]
    return usual([r for r in fine if zero or any(r[1])])


def ranked(rows, every, k, score, best_first):
    queries = {}
    for i, v in sorted(rows):
        if i % every == 0:
            queries.setdefault(i, v)
    out = []
    for q, v in queries.items():
        found = sorted((best_first(score(v, x)), i) for i, x in rows if i != q)[:k]
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(found)]
    return out


def by_distance(rows, every=10, k=5):
    def away(a, b):
        total = 0.0
        for x, y in zip(a, b, strict=True):
            total += (x - y) ** 2
        return sqrt(total)

    return ranked(useful(rows, False), every, k, away, lambda s: s)


def by_product(rows, every=10, k=5):
    whole = [(i, [floor(1024 * x) for x in v]) for i, v in useful(rows, True)]
    found = ranked(whole, every, k, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)), lambda s: -s)
    return [(q, n, i, -s) for q, n, i, s in found]


def made(n, dim=6, seed=0, spread=1.0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, dim)) * spread
    rows = [(int(i), (centres[i % 5] + draw.normal(size=dim) * 0.3).tolist()) for i in range(n)]
    return rows


CASES = {
    "clusters": made(300),
    "tight clusters": made(300, spread=50.0, seed=1),
    "one vector has most rows": made(60) + [(1000 + i, [0.5] * 6) for i in range(150)],
    "all equal": [(i, [1.0, 2.0]) for i in range(50)],
    "whole numbers with ties": [(i, [float(i % 3), float(i % 2)]) for i in range(90)],
    "repeated rows and ids": made(40) + made(40) + [(10, [9.0] * 6), (10, [-9.0] * 6)],
    "odd rows": made(30) + [(100, None), (110, []), (120, [NAN] * 6), (130, [INF] * 6), (140, [None] * 6), (150, [0.0] * 6), (160, [1.0]), (None, [1.0] * 6)],
    "few rows": made(4),
    "one row": [(0, [1.0, 1.0])],
    "no query": [(i, [1.0, float(i)]) for i in range(1, 9)],
    "nothing useful": [(0, None), (10, [NAN])],
    "negative ids": [(-i, v) for i, v in made(50)],
}


@pytest.mark.parametrize("name", CASES)
def test_block_join(spark, name):
    docs = spark.createDataFrame([(*r, 1.0) for r in CASES[name]], VECTORS + ", score double")
    got = sorted(map(tuple, nearest(docs, 5, 10, query_block=4, data_block=16).collect()))
    assert got == sorted(by_distance(CASES[name]))


@pytest.mark.parametrize("name", CASES)
def test_voronoi_join(spark, name):
    docs = spark.createDataFrame([(*r, 1.0) for r in CASES[name]], VECTORS + ", score double")
    got = sorted(map(tuple, top_k(docs, 5, 10, n_pivots=7, group_queries=4, chunk_rows=32).collect()))
    assert got == sorted(by_product(CASES[name]))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert nearest(empty).collect() == []
    assert top_k(empty).collect() == []


def test_large_whole_numbers_are_exact(spark):
    rows = [(i, [float(2**19 + i), float(-(2**19) + 3 * i)]) for i in range(40)]
    got = sorted(map(tuple, top_k(spark.createDataFrame(rows, VECTORS), 5, 10).collect()))
    assert got == sorted(by_product(rows))


def test_quantisation_bounds_hold():
    draw = np.random.default_rng(4)
    a, b = draw.normal(size=(40, 9)) * 10, draw.normal(size=(70, 9))
    least, most = Quantised(a).bounds(Quantised(b), slice(0, 70))
    for i in range(40):
        for j in range(70):
            exact = float(sum((Fraction(float(x)) - Fraction(float(y))) ** 2 for x, y in zip(a[i], b[j], strict=True)))
            assert least[i, j] <= exact <= most[i, j]


def test_cell_bounds_hold():
    draw = np.random.default_rng(5)
    rows = np.floor(draw.normal(size=(400, 5)) * 500)
    queries = np.floor(draw.normal(size=(60, 5)) * 500)
    pivots = Pivots(rows[:12], float((rows**2).sum(axis=1).max()))
    away, cells = pivots.of_rows(rows), pivots.of_rows(rows).argmin(axis=1)

    class Row:
        def __init__(self, cell, vec_id, away):
            self.cell, self.vec_id, self.away = cell, vec_id, away

    summary = [Row(int(c), i, away[i, c]) for c in range(12) for i in np.flatnonzero(cells == c)[np.argsort(away[cells == c, c])][:6]]
    of_query = pivots.of_queries(queries)
    radius = {int(c): float(of_query[of_query.argmin(axis=1) == c, c].max()) for c in set(of_query.argmin(axis=1).tolist())}
    reach = bounds(pivots, radius, summary, 5)
    full = np.sqrt((queries**2).sum(axis=1)[:, None] + pivots.longest - 2 * queries @ rows.T)
    for q, cell in enumerate(of_query.argmin(axis=1).tolist()):
        assert np.sort(full[q])[5] <= reach[cell] + pivots.room
        for near in np.argsort(full[q])[:5]:
            assert away[near, cell] <= reach[cell] + radius[cell] + pivots.room


def test_groups_hold_all_cells():
    pivots = Pivots(np.random.default_rng(6).normal(size=(9, 3)), 100.0)
    sizes = {0: 5, 1: 40, 2: 1, 5: 7, 8: 3}
    groups = groups_of(pivots, sizes, 10)
    assert sorted(c for cells, _ in groups for c in cells) == sorted(sizes)
    for cells, parts in groups:
        assert sum(sizes[c] for c in cells) <= 10 * parts and (parts == 1 or len(cells) == 1)


def exact(rows, every=10, k=5):
    whole = [(i, [floor(Fraction(x) * 1024) for x in v]) for i, v in rows]
    found = ranked(whole, every, k, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)), lambda s: -s)
    return sorted((q, n, i, -s) for q, n, i, s in found)


LONG = {
    "beyond 2^20": [(i, [1.0 + i / 8, 0.5, -0.25]) for i in range(60)] + [(61 + i, [2.0**21 + i, 2.0**24, 0.0]) for i in range(9)],
    "no fraction": [(i, [2.0**-10, i / 64]) for i in range(60)] + [(61, [2.0**44, 1.0]), (63, [2.0**44 + 2.0**-8, 1.0])],
    "far below a long": [(i, [1.0 + i / 8, 0.5]) for i in range(60)] + [(1001 + 10 * i, [-(2.0**100) * (i + 1), 3.0]) for i in range(30)],
    "squares beyond a double": [(i, [1.0 + i / 8, 0.5]) for i in range(60)] + [(1001 + 10 * i, [-(2.0**900), 3.0 + i]) for i in range(30)],
    "sums past 2^63 on the way": [(i, [2.0**21 - i] * 32 + [i - 2.0**21] * 32) if i % 2 else (i, [1.0 * (i + 2**20)] * 64) for i in range(40)],
}
FITTING = [name for name in LONG if all(-(2**63) <= s < 2**63 for *_, s in exact(LONG[name]))]


def test_cases_that_fit_a_long():
    assert FITTING == list(LONG)[:4]


@pytest.mark.parametrize("name", LONG)
def test_long_vectors_take_part(spark, name):
    docs = spark.createDataFrame(LONG[name], "vec_id long, embedding array<double>")
    found = top_k(docs, 5, 10, n_pivots=7, group_queries=4, chunk_rows=8)
    if name in FITTING:
        assert sorted(map(tuple, found.collect())) == exact(LONG[name])
    else:
        with pytest.raises(Exception, match="does not fit a long"):
            found.collect()


def test_distances_beyond_the_largest_double_keep_their_rows(spark):
    rows = [(i, [1e160 * (i + 1), float(i)]) for i in range(12)] + [(100 + i, [float(i), 1.0]) for i in range(5)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=10, every=10).collect()
    found = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 10, 100)}
    # all distances from these are infinite, so ids decide
    assert found[0] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10] and found[10] == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert found[100][:4] == [101, 102, 103, 104] and len(found[100]) == 10
