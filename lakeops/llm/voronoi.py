"""Exact top-k search by inner product as a Voronoi kNN join.

Vectors become whole numbers, floor(scale * x). With one more component, sqrt(M^2 - |x|^2)
for rows (M the greatest length of a row) and 0 for queries, the row with the greatest inner
product is the nearest one: |q - x|^2 = |q|^2 + M^2 - 2 <q, x>. The space is cut into the
Voronoi cells of a few rows, the pivots. Summaries of the cells (of queries: number and
radius; of rows: the k + 1 smallest distances to the pivot) give each query cell a bound on
the distance of the k-th neighbour of all its queries. Query cells form groups of bounded
size, and a row is sent to the groups that have a cell in whose bound it can lie, by its
distance to that cell's pivot. Rows of a group are cut into chunks of bounded size, so that
neither a hot cell nor a hot vector meets in one task; a chunk is solved with exact whole
numbers, and the results of the chunks are merged.

Defined results: vectors that are NULL, empty, or hold a NULL or a component that is not
finite take no part; neither do rows without an id and vectors of another length than the most
frequent one. Scores of any size are compared exactly; one among the best that does not fit a
long, or a component that is not finite after scaling, is an error.
Every row is a candidate of its own, also one that repeats another; rows with the query's id
are not. Of rows that repeat a query's id the smallest vector asks. Ties go to the smaller
id. An empty table gives an empty result. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import frexp

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.llm.registry import query, table
from lakeops.llm.vectors import asked, finite, matrix, numbered, ranked
from lakeops.session import staged

RESULT = "query_id long, rank int, vec_id long, score long"
#: from here on, whole numbers of a double have no fraction, and their products may need exact sums
WHOLE = 2.0**53
#: squares above this are taken of smaller units
LONGEST = 1e300
#: relative room for rounding in distances
ROOM = 1e-6


class Pivots:
    """Distances to the pivots in the space with one more component, in units of ``unit``."""

    def __init__(self, rows: np.ndarray, longest: float, unit: float = 1.0):
        self.longest, self.unit = longest, unit
        rows = rows / unit
        self.at = np.column_stack([rows, self.lift(rows)])
        self.between = self._away(self.at)

    def lift(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, self.longest - (rows**2).sum(axis=1)))

    def _away(self, rows: np.ndarray) -> np.ndarray:
        squares = (rows**2).sum(axis=1)[:, None] + (self.at**2).sum(axis=1) - 2 * rows @ self.at.T
        return np.sqrt(np.maximum(0, squares))

    def of_rows(self, rows: np.ndarray) -> np.ndarray:
        rows = rows / self.unit
        return self._away(np.column_stack([rows, self.lift(rows)]))

    def of_queries(self, queries: np.ndarray) -> np.ndarray:
        return self._away(np.column_stack([queries / self.unit, np.zeros(len(queries))]))

    @property
    def room(self) -> float:
        """What rounding may take from any distance here."""
        return ROOM * (1 + np.sqrt(self.longest))


def batches_of(frames: Iterator[pd.DataFrame], most: int = 4096) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for low in range(0, len(frame), most):
            yield frame.iloc[low : low + most]


def summaries(rows: DataFrame, pivots: Pivots, k: int) -> list:
    """(cell, away) of the ``k`` + 1 rows nearest to each pivot in its cell, one for an id at most.

    At most pivots x (k + 1) rows reach the driver.
    """

    def nearest_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames):
            away = pivots.of_rows(matrix(frame.v))
            cell = away.argmin(axis=1)
            out = pd.DataFrame({"cell": cell, "vec_id": frame.vec_id.to_numpy(), "away": away.min(axis=1)})
            out = out.sort_values("away").drop_duplicates(["cell", "vec_id"])
            yield out.groupby("cell").head(k + 1)

    found = rows.select("vec_id", "v").mapInPandas(nearest_of, "cell int, vec_id long, away double")
    found = found.groupBy("cell", "vec_id").agg(F.min("away").alias("away"))
    order = W.partitionBy("cell").orderBy("away", "vec_id")
    found = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    return found.select("cell", "vec_id", "away").collect()


def bounds(pivots: Pivots, radius: dict[int, float], nearest: list, k: int) -> dict[int, float]:
    """For each query cell a distance within which all its queries have ``k`` rows of other ids."""
    found = {}
    if not nearest:
        return dict.fromkeys(radius, np.inf)
    cells = np.array([r.cell for r in nearest])
    ids, away = np.array([r.vec_id for r in nearest]), np.array([r.away for r in nearest])
    for cell, reach in radius.items():
        upper = pivots.between[cell, cells] + reach + away
        order = np.argsort(upper)
        _, first = np.unique(ids[order], return_index=True)
        upper = np.sort(upper[order][first])
        # one of them may be the query's own
        found[cell] = upper[k] if len(upper) > k else np.inf
    return found


def groups_of(pivots: Pivots, sizes: dict[int, int], most: int) -> list[tuple[list[int], int]]:
    """Groups of neighbouring cells with about ``most`` queries, and in how many parts to cut each.

    Only a cell with more queries than that is cut.
    """
    left, groups = dict(sizes), []
    while left:
        cell = max(left, key=lambda c: (left[c], -c))
        members, total = [cell], left.pop(cell)
        for near in np.argsort(pivots.between[cell]).tolist():
            if near in left and total + left[near] <= most:
                members.append(near)
                total += left.pop(near)
        groups.append((members, -(-total // most)))
    return groups


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) of each query's ``k`` best rows of one chunk."""
    most = float(np.abs(queries).max()) * float(np.abs(rows).max()) * rows.shape[1]
    if most >= 2.0**62:
        return best_of_long(query_ids, queries, ids, rows, k)
    if most < WHOLE:
        scores = queries @ rows.T
    else:
        scores = queries.astype(np.int64) @ rows.astype(np.int64).T
    out = []
    for query_id, line in zip(query_ids.tolist(), scores, strict=True):
        other = np.flatnonzero(ids != query_id)
        line = line[other]
        if len(line) > k:
            chosen = np.flatnonzero(line >= np.partition(line, len(line) - k)[len(line) - k])
            line, other = line[chosen], other[chosen]
        order = np.lexsort((ids[other], -line))[:k]
        out += [(query_id, int(ids[other[i]]), int(line[i])) for i in order]
    return out


def power_of_two(most: float) -> float:
    """The power of two of which ``most`` is less than the double; 1 for 0."""
    return 2.0 ** (frexp(most)[1] - 1) if most else 1.0


def best_of_long(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """``best`` for scores of any size: rows that rounding leaves possible are compared in Python's numbers."""
    dim = rows.shape[1]
    small = rows / power_of_two(float(np.abs(rows).max()))
    units = np.array([power_of_two(float(m)) for m in np.abs(queries).max(axis=1)])
    scores = (queries / units[:, None]) @ small.T
    # more than rounding takes from a sum of products, and than products too small for a double
    room = dim * dim * 2.0**-49 * np.abs(small).max(axis=1) + 1e-290
    whole: dict[int, list[int]] = {}
    out = []
    for query_id, query, line in zip(query_ids.tolist(), queries.tolist(), scores, strict=True):
        other = np.flatnonzero(ids != query_id)
        if len(other) > k:
            least = np.partition(line[other] - room[other], len(other) - k)[len(other) - k]
            other = other[line[other] + room[other] >= least]
        asked_for = [int(x) for x in query]
        found = []
        for i in other.tolist():
            if i not in whole:
                whole[i] = [int(x) for x in rows[i].tolist()]
            found.append((-sum(a * b for a, b in zip(asked_for, whole[i], strict=True)), int(ids[i])))
        out += [(query_id, vec_id, -score) for score, vec_id in sorted(found)[:k]]
    return out


def sortable(score: int) -> tuple[int, int, bytes]:
    """(over, value, wide) in the order of the scores; a score that fits a long is the value, and over is 0."""
    if -(1 << 63) <= score < 1 << 63:
        return 0, score, b""
    return (1 if score > 0 else -1), 0, (score + (1 << 2200)).to_bytes(280, "big")


def top_k(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    n_pivots: int = 128,
    group_queries: int = 2048,
    chunk_rows: int = 8192,
) -> DataFrame:
    """query_id, rank, vec_id and score (whole inner product) of each query's ``k`` best rows."""
    def floored(x: Column) -> Column:
        scaled = x * scale
        small = F.when(F.abs(scaled) < WHOLE, F.floor(scaled).cast("double"))
        too_large = F.raise_error("a component of a vector is not finite after scaling").cast("double")
        return small.when(F.abs(scaled) < float("inf"), scaled).otherwise(too_large)

    useful = finite(F.col(vector_col))
    whole = F.transform(F.col(vector_col).cast("array<double>"), floored)
    spark = vectors.sparkSession
    rows = numbered(
        vectors.filter(useful).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")), "voronoi"
    )
    queries = staged(asked(rows, every), "voronoi-queries")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    peak = F.max(F.array_max(F.transform("v", F.abs))).alias("peak")
    count = rows.agg(F.count("*").alias("n"), F.max(square).alias("longest"), peak).first()
    if not count.n:
        return spark.createDataFrame([], RESULT)
    longest, unit = float(count.longest), 1.0
    if longest > LONGEST:
        unit = power_of_two(count.peak)
        in_units = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / unit) * (x / unit))
        longest = float(rows.agg(F.max(in_units)).first()[0])
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").select("v").limit(n_pivots).collect()
    pivots = Pivots(np.unique(np.array([r.v for r in drawn]), axis=0), longest, unit)

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames):
            away = pivots.of_queries(matrix(frame.v))
            yield frame.assign(cell=away.argmin(axis=1), away=away.min(axis=1))

    celled = queries.select("vec_id", "v").mapInPandas(placed, "vec_id long, v array<double>, cell int, away double")
    celled = staged(celled, "voronoi-celled")
    per_cell = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("reach")).collect()
    reach = bounds(pivots, {r.cell: r.reach for r in per_cell}, summaries(rows, pivots, k), k)
    radius = {r.cell: r.reach for r in per_cell}
    groups = groups_of(pivots, {r.cell: r.n for r in per_cell}, group_queries)
    chunks = -(-count.n // chunk_rows)

    # rows go to every part of the groups that they can matter to
    within = np.full((len(groups), len(pivots.at)), -np.inf)
    for g, (cells, _) in enumerate(groups):
        for cell in cells:
            within[g, cell] = reach[cell] + radius[cell] + pivots.room

    def sent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames):
            away = pivots.of_rows(matrix(frame.v))
            for g, (_, parts) in enumerate(groups):
                taken = frame[(away <= within[g]).any(axis=1)]
                for part in range(parts):
                    yield pd.DataFrame(
                        {"g": g, "part": part, "chunk": taken.n % chunks, "id": taken.vec_id, "x": taken.v}
                    )

    right = rows.mapInPandas(sent, "g int, part int, chunk long, id long, x array<double>")
    group_of = {cell: g for g, (cells, _) in enumerate(groups) for cell in cells}
    if not group_of:
        return spark.createDataFrame([], RESULT)
    known = spark.createDataFrame([(c, g, groups[g][1]) for c, g in group_of.items()], "cell int, g int, parts int")
    left = celled.join(F.broadcast(known), "cell").select(
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("q"),
        "g",
        F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"),
    )

    def solved(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            found = best(a.query_id.to_numpy(), matrix(a.q), b.id.to_numpy(), matrix(b.x), k)
        found = [(query_id, vec_id, *sortable(score)) for query_id, vec_id, score in found]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "over", "value", "wide"])

    key = ("g", "part", "chunk")
    found = left.groupBy(*key).cogroup(right.groupBy(*key))
    found = found.applyInPandas(solved, "query_id long, vec_id long, over int, value long, wide binary")
    found = found.select("query_id", "vec_id", F.struct("over", "value", "wide").alias("score"))
    unfit = F.raise_error("a score among the best does not fit a long").cast("long")
    score = F.when(F.col("score.over") == 0, F.col("score.value")).otherwise(unfit)
    return ranked(found, k, F.desc("score")).withColumn("score", score)


TOP_K_SQL = """
WITH fine AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM fine q JOIN fine c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query("op1_voronoi_top_k", TOP_K_SQL)
def op1_voronoi_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
