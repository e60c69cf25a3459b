"""Centroid clustering in integers by a bisector tournament.

Two centroids are parted by the plane half-way between them.  Its normal and threshold are
integers, computed once for every ordered pair; a vector lies on the side of centroid ``j`` if

    2 (c_j - c_w) . x  >  |c_j|^2 - |c_w|^2.

A vector starts with centroid 0 as winner and meets the others in ascending order, so after
k - 1 sign tests one is left; a zero leaves the earlier, smaller number.  Only the
distance to the last winner is computed.

Every task adds up its vectors by centroid; the k rows of sums of each task are added up
exactly by Spark, and the driver sees the k rows of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from lodestrata.llm.common import stored

K, ROUNDS, SEED = 40, 5, 2
SIZE, SCALE = 64, 256
#: Largest component, before scaling, for which every test and distance fits 64 bits.
LARGEST = 1 << 19
_ROWS = 2048  # vectors tested at a time


class Bisectors:
    """The planes between the centroids, the rows of an integer matrix."""

    def __init__(self, centroids: np.ndarray):
        c = centroids.astype(np.int64)
        self.centroids = c
        self.normals = 2 * (c[None, :, :] - c[:, None, :])  # [winner, challenger]
        norms = (c * c).sum(1)
        self.thresholds = norms[None, :] - norms[:, None]

    def winners(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row; of equally near ones the smallest number."""
        best = np.zeros(len(vectors), np.int64)
        for at in range(0, len(vectors), _ROWS):
            x, w = vectors[at : at + _ROWS], best[at : at + _ROWS]
            for j in range(1, len(self.centroids)):
                side = np.einsum("ij,ij->i", x, self.normals[w, j]) - self.thresholds[w, j]
                w[side > 0] = j
        return best

    def distances(self, vectors: np.ndarray, winners: np.ndarray) -> np.ndarray:
        away = vectors - self.centroids[winners]
        return (away * away).sum(1)


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the vector in integers floor(scale * x), of the rows that take part:
    ``size`` components, none null, NaN, infinite or past ``LARGEST``."""
    source = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("x"))
    fits = (F.size("x") == size) & F.forall("x", lambda c: F.abs(c.cast("double")) <= LARGEST)
    return source.where(fits).select(
        "vec_id", F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("int")).alias("v")
    )


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED, size: int = SIZE) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; rows of one id by their vectors.
    Rows without an id are none."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").where("key IS NOT NULL").orderBy("key", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), size)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), size).astype(np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the exact floor of the mean of its vectors; empty ones stay."""
    k, size = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        many, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), size)
            won = planes.winners(x)
            many += np.bincount(won, minlength=k)
            order = np.argsort(won, kind="stable")
            own, first = np.unique(won[order], return_index=True)
            if len(own):
                total[own] += np.add.reduceat(x[order], first, axis=0)
        own = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(many[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    parts = vectors.select("v").mapInArrow(sums, "cluster int, n bigint, sums array<bigint>")
    whole = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(size)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *whole).collect():
        out[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(size)]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    size = centroids.shape[1]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        for batch in batches:
            x = _matrix(batch.column(1), size)
            won = planes.winners(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(won, pa.int32()), pa.array(planes.distances(x, won))],
                ["vec_id", "cluster", "distance"],
            )

    kept = vectors.select("vec_id", "v")
    out = StructType([kept.schema["vec_id"], StructField("cluster", IntegerType()), StructField("distance", LongType())])
    return kept.mapInArrow(nearest, out)


def cluster(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    seed: int = SEED,
    size: int = SIZE,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of the rows
    whose vector takes part (``integer_vectors``); other rows give none, and an empty table gives none.

    Repeated rows and ids count each.  With fewer vectors than ``k`` every one is a centroid; of equal
    centroids the smallest number has the vectors and the others stay where they are.  Rows
    without an id are assigned, but start no centroid; where no row has an id, the result is
    empty.  A sum of distances past 64 bits is null.  Other columns are left out."""
    spark = rows.sparkSession
    vectors = stored(integer_vectors(rows, vec_id, vector, size, scale), "vectors")
    centroids = first_centroids(vectors, k, seed, size)
    if not len(centroids):
        vectors = vectors.where(F.lit(False))
        centroids = np.zeros((1, size), np.int64)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    found = stored(assigned(vectors, centroids), "clusters")
    sums = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}

    def long(value: int) -> int | None:
        return value if value < 1 << 63 else None

    whole = long(sum(sums.values()))
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    schema = StructType(
        [
            StructField("cluster", IntegerType()),
            StructField("cluster_inertia", LongType()),
            StructField("inertia", LongType()),
            StructField("centroid_sha256", StringType()),
        ]
    )
    # A row for each centroid.
    facts = spark.createDataFrame([(c, long(d), whole, names[c]) for c, d in sorted(sums.items())], schema)
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
