"""Nearest neighbours by a block matrix join over quantised vectors.

Queries and data are cut into blocks, and every pair of blocks is a tile of its own. A tile
holds its vectors as 8-bit whole numbers with one scale per vector and the exact length of
what rounding took away. The product of the whole numbers gives every distance with a bound
of its error; a pair survives if its least possible distance is not above the k-th greatest
possible one, nor above the k-th distance in the query's heap. Survivors are computed again
from the original components in double precision and go into the heap, and the heaps of all
tiles are merged. The bounds are safe, so the result is the exact one.

The number of tiles is (rows / ``data_block``) x (queries / ``query_block``): the queries are
a stated set, and each is compared with all rows in blocks.

Defined results: vectors that are NULL, empty, zero, or hold a NULL or a component that is
not finite take no part; neither do rows without an id and vectors of another length than the
most frequent one. Every row is a candidate of its own, also one that repeats another; rows
with the query's id are not. Of rows that repeat a query's id the smallest vector asks. Ties
go to the smaller id. An empty table gives an empty result. Other columns are not used.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.registry import query, table
from lakeops.llm.vectors import asked, finite, matrix, numbered, ranked

RESULT = "query_id long, vec_id long, score double"
#: rows of a product tile inside a block, and survivors computed at a time
STRIP = 2048
PAIRS = 1 << 16


class Quantised:
    """Rows as 8-bit whole numbers: row = scale * whole + rest."""

    def __init__(self, rows: np.ndarray):
        self.scale = np.maximum(np.abs(rows).max(axis=1) / 127, np.finfo(np.float64).tiny)
        self.whole = np.rint(rows / self.scale[:, None]).astype(np.int8)
        kept = self.whole * self.scale[:, None]
        self.rest = np.sqrt(((rows - kept) ** 2).sum(axis=1))
        self.kept = np.sqrt((kept**2).sum(axis=1))
        self.square = (rows**2).sum(axis=1)

    def bounds(self, other: Quantised, strip: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible squared distances of own rows to a strip of the other's."""
        # sums of 8-bit products are exact as 32-bit floats up to 2^24, that is 1,040 components
        exact = np.float32 if self.whole.shape[1] <= 1040 else np.float64
        product = (self.whole.astype(exact) @ other.whole[strip].astype(exact).T).astype(np.float64)
        product *= self.scale[:, None] * other.scale[strip]
        # <x, y> - <kept x, kept y> = <x, rest y> + <rest x, kept y>
        error = np.sqrt(self.square)[:, None] * other.rest[strip] + self.rest[:, None] * other.kept[strip]
        about = self.square[:, None] + other.square[strip] - 2 * product
        slack = 2 * error + 1e-9 * (self.square[:, None] + other.square[strip])
        least, most = about - slack, about + slack
        # squares beyond the largest double say nothing
        return np.where(np.isfinite(least), least, -np.inf), np.where(np.isfinite(most), most, np.inf)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, summed in the order of the components."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += (a[:, i] - b[:, i]) ** 2
    return np.sqrt(total)


def solve(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, distance) of each query's ``k`` nearest rows of one tile."""
    with np.errstate(over="ignore", invalid="ignore"):
        return solved(query_ids, queries, ids, rows, k)


def solved(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    small_q, small_x = Quantised(queries), Quantised(rows)
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    for low in range(0, len(ids), STRIP):
        strip = slice(low, low + STRIP)
        least, most = small_q.bounds(small_x, strip)
        own = query_ids[:, None] == ids[strip]
        least[own] = most[own] = np.inf
        kth = np.partition(most, k - 1, axis=1)[:, k - 1] if most.shape[1] >= k else np.full(len(most), np.inf)
        held = np.array([h[0][0] ** 2 * (1 + 1e-9) if len(h) == k else np.inf for h in heaps])
        where_q, where_x = np.nonzero((least <= np.minimum(kth, held)[:, None]) & ~own)
        for at in range(0, len(where_q), PAIRS):
            q, x = where_q[at : at + PAIRS], where_x[at : at + PAIRS] + low
            away = distances(queries[q], rows[x])
            order = np.lexsort((ids[x], away, q))
            place = np.arange(len(q)) - np.searchsorted(q[order], q[order])
            for i in order[place < k].tolist():
                heap, item = heaps[q[i]], (-away[i], -int(ids[x[i]]))
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
    return [(int(q), -i, -d) for q, heap in zip(query_ids, heaps, strict=True) for d, i in heap]


def nearest(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = 1024,
    data_block: int = 8192,
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's ``k`` nearest rows."""
    vector = F.col(vector_col).cast("array<double>")
    useful = finite(F.col(vector_col)) & F.exists(vector, lambda x: x != 0)
    rows = numbered(
        vectors.filter(useful).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v")), "block-knn"
    )
    queries = asked(rows, every)
    counts = rows.agg(F.count("*").alias("rows"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("queries")).first()
    down, across = -(-counts.rows // data_block) or 1, -(-counts.queries // query_block) or 1

    # names of their own: both sides come from the same rows
    left = queries.select(
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("q"),
        F.pmod(F.xxhash64("vec_id"), F.lit(across)).cast("int").alias("column"),
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("row"),
    )
    right = rows.select(
        F.col("vec_id").alias("id"),
        F.col("v").alias("x"),
        (F.col("n") % down).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("column"),
    )

    def tile(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            found = solve(a.query_id.to_numpy(), matrix(a.q), b.id.to_numpy(), matrix(b.x), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    tiles = left.groupBy("row", "column").cogroup(right.groupBy("row", "column"))
    found = tiles.applyInPandas(tile, RESULT)
    return ranked(found, k, F.col("score"))


KNN_SQL = """
WITH fine AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    -- summed in the order of the components, as list_distance does not
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(
        range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda a, b: a + b)) AS score
    FROM fine q JOIN fine c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query("op10_block_knn", KNN_SQL)
def op10_block_knn(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
