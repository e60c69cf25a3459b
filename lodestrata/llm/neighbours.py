"""Approximate nearest neighbours by counting collisions on single projections.

Inner products become distances: vectors are scaled by the largest norm and get one
coordinate more that brings them to length one; queries are scaled to length one.  The
vector of largest inner product is then the nearest.

The index of a block of vectors is, for each of ``PROJECTIONS`` random directions, the
array of its projections in order.  A query opens a window around its own projection in
every array and widens all of them by ``GROWTH`` at a time (virtual rehashing).  A vector
collides where it lies in the window; one that has collided in ``threshold`` of the arrays is
verified on the original vector, in double precision.  The search ends when as many
verified vectors as are wanted lie within the radius of the windows: nearer ones collide
in more arrays than the threshold with a known probability (``MISS`` standard deviations).

Equal vectors are one entry of the index with their smallest ids.  Every vector is indexed;
blocks of queries meet blocks of vectors, and the best of each are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
PROJECTIONS = 64
HALF_WIDTH = 1.36  # of a window, in radii
MISS = 1.0
GROWTH = 1.12
#: Scaled vectors are at most 2 apart; the last window holds every array whole.
RADII = np.append(0.2 * GROWTH ** np.arange(21), np.inf)
VECTORS_PER_BLOCK = 1 << 16
QUERIES_PER_BLOCK = 512


def threshold(projections: int = PROJECTIONS, miss: float = MISS) -> int:
    """Collisions that a vector at the radius has but for ``miss`` deviations."""
    p = math.erf(HALF_WIDTH / math.sqrt(2))
    return max(1, math.floor(projections * p - miss * math.sqrt(projections * p * (1 - p))))


class Index:
    """Sorted projections of distinct vectors; ids: the smallest ids of each."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray], largest: float, seed: int = 5):
        self.vectors = vectors.astype(np.float64)
        self.ids = ids
        self.many = np.array([len(i) for i in ids])
        unit = self.vectors / largest
        extra = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(1)))
        rng = np.random.default_rng(seed)
        self.axes = rng.normal(size=(vectors.shape[1] + 1, PROJECTIONS))
        projected = np.concatenate([unit, extra[:, None]], 1) @ self.axes
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.take_along_axis(projected, order, 0).T.copy()
        self.order = order.T.copy()
        self.rough = self.vectors.astype(np.float32)
        self.largest = largest

    def search(self, query: np.ndarray, own: int, k: int, wanted: int) -> list[tuple[int, float]]:
        """(id, inner product), best first, ties to the smaller id."""
        n = len(self.vectors)
        query = query.astype(np.float64)
        length = float(np.sqrt((query * query).sum()))
        scale = self.largest * length
        at = (query / length) @ self.axes[:-1]
        # Windows of all radii: their ends in every array.
        reach = HALF_WIDTH * RADII
        low = np.array([row.searchsorted(x - reach, "left") for row, x in zip(self.sorted, at)])
        high = np.array([row.searchsorted(x + reach, "right") for row, x in zip(self.sorted, at)])
        counts = np.zeros(n, np.int64)
        verified = np.zeros(n, bool)
        scores = np.full(n, -np.inf, np.float32)
        rough = query.astype(np.float32)
        for step, radius in enumerate(RADII):
            if step:
                ends = zip(self.order, low[:, step], low[:, step - 1], high[:, step - 1], high[:, step])
                fresh = [part for o, a, b, c, d in ends for part in (o[a:b], o[c:d])]
            else:
                fresh = [o[a:b] for o, a, b in zip(self.order, low[:, 0], high[:, 0])]
            counts += np.bincount(np.concatenate(fresh), minlength=n)
            new = np.flatnonzero((counts >= wanted) & ~verified)
            if not len(new):
                continue
            verified[new] = True
            scores[new] = self.rough[new] @ rough
            # |x - q|^2 = 2 - 2 x.q of the scaled vectors.
            near = scores >= (1 - radius * radius / 2) * scale
            if self.many[near].sum() > k:
                break
        found = np.flatnonzero(verified)
        if len(found) > k + 1:
            least = np.partition(scores[found], -(k + 1))[-(k + 1)]
            found = found[scores[found] >= least - 1e-5 * scale]
        exact = (self.vectors[found] * query).sum(1)
        rows = [(i, float(s)) for v, s in zip(found, exact) for i in self.ids[v].tolist() if i != own]
        return sorted(rows, key=lambda r: (-r[1], r[0]))[:k]


def usable(column: str) -> Column:
    """Not null, not empty, finite in every component, not all zero."""
    c = F.col(column)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return c.isNotNull() & (F.size(c) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(c, lambda x: x != 0)


def search(
    rows: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    vectors_per_block: int = VECTORS_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
    miss: float = MISS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products found for each
    row that is a query, among all rows but its own id.

    Vectors that are null, empty, zero or hold null or non-finite components take no part,
    nor do null ids, nor vectors of another length than most (ties: the longer).  Of equal
    vectors the smallest ids come first.  With fewer than ``k`` candidates all are returned.
    Repeated rows count once; an id with several vectors has them all, as query and as
    candidate.  An empty table gives no rows."""
    own = rows.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    good = own.where(F.col("id").isNotNull() & usable("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    kinds = (
        good.groupBy(F.size("v").alias("d"))
        .agg(F.count("*").alias("n"), F.countDistinct(F.xxhash64("v")).alias("distinct"), F.max(squares).alias("top"),
             F.sum(F.col("asks").cast("int")).alias("asked"))
        .orderBy(F.desc("n"), F.desc("d"))
        .limit(1)
        .collect()
    )
    spark = rows.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not kinds or not kinds[0]["asked"]:
        return spark.createDataFrame([], schema)
    kind = kinds[0]
    largest = math.sqrt(kind["top"])
    blocks = max(1, math.ceil(kind["distinct"] / vectors_per_block))
    rounds = max(1, math.ceil(kind["asked"] / queries_per_block))
    same = good.where(F.size("v") == kind["d"])
    # Of equal vectors, k + 1 ids are enough for any query; the limit acts before the shuffle.
    first = Window.partitionBy("v").orderBy("id")
    entries = (
        same.select("v", "id").withColumn("place", F.dense_rank().over(first)).where(F.col("place") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        .withColumn("block", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int"))
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
        .select("block", "round", "v", "ids")
    )
    queries = (
        same.where("asks").select("id", "v")
        .withColumn("round", F.pmod(F.xxhash64("id"), F.lit(rounds)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select("block", "round", "id", "v")
    )
    dim, wanted = kind["d"], threshold(miss=miss)

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        return np.asarray(column.combine_chunks().flatten()).reshape(-1, dim)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            index = Index(
                matrix(left.column("v")), [np.array(i) for i in left.column("ids").to_pylist()], largest
            )
            for own, q in zip(right.column("id").to_pylist(), matrix(right.column("v"))):
                out += [(own, i, s) for i, s in index.search(q, own, k, wanted)]
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.table(
            {
                "query_id": pa.array(columns[0], pa.int64()),
                "vec_id": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], pa.float64()),
            }
        )

    found = (
        entries.groupBy("block", "round")
        .cogroup(queries.groupBy("block", "round"))
        .applyInArrow(answer, "query_id bigint, vec_id bigint, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
