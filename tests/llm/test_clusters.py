import hashlib
import math
import random

import numpy as np
import pytest

from lodestrata.llm import clusters as c

SCHEMA = "vec_id long, embedding array<float>, cluster string, v long"


def brute(rows, k, rounds, size):
    """Plain integers, every distance computed."""
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [r for r in kept if r[0] is not None]
    named.sort(key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in named[:k]]

    def distance(x, y):
        return sum((a - b) ** 2 for a, b in zip(x, y))

    def nearest(x):
        return min(range(len(centroids)), key=lambda j: (distance(x, centroids[j]), j))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v), []).append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(col) // len(vs) for col in zip(*vs)]
    found = [(i, nearest(v), distance(v, centroids[nearest(v)])) for i, v in kept]
    whole = sum(d for _, _, d in found)
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in centroids]
    return sorted(
        ((i, j, d, sum(e for _, o, e in found if o == j), whole, sha[j]) for i, j, d in found), key=str
    )


def test_tournament_as_all_distances():
    rng = np.random.default_rng(4)
    for _ in range(50):
        k, size = int(rng.integers(1, 9)), int(rng.integers(1, 4))
        centroids = rng.integers(-3, 4, (k, size))  # small numbers: many ties and equal centroids
        x = rng.integers(-4, 5, (60, size))
        d = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
        planes = c.Bisectors(centroids)
        won = planes.winners(x)
        assert won.tolist() == d.argmin(1).tolist()
        assert planes.distances(x, won).tolist() == d.min(1).tolist()


def test_largest_components_do_not_overflow():
    top = c.LARGEST * c.SCALE
    centroids = np.array([[top] * c.SIZE, [-top] * c.SIZE, [0] * c.SIZE])
    x = np.array([[top] * c.SIZE, [-top] * c.SIZE, [1 - top] * c.SIZE, [3] * c.SIZE])
    planes = c.Bisectors(centroids)
    assert planes.winners(x).tolist() == [0, 1, 1, 2]
    assert planes.distances(x, np.array([1, 0, 0, 2]))[0] == c.SIZE * (2 * top) ** 2


@pytest.mark.parametrize("k,size", [(5, 4), (40, 3)])
def test_whole_against_brute_force(spark, scratch, k, size):
    rng = random.Random(size)
    rows = [(i, [rng.choice([-1.0, -0.3, 0.001, 0.5, 2.25]) for _ in range(size)]) for i in range(120)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (3, rows[3][1]), (None, rows[5][1])]
    odd = [(900, None), (901, []), (902, [0.5] * (size + 1)), (903, [None] * size), (904, [math.nan] * size), (905, [math.inf] * size)]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], SCHEMA).repartition(3)
    got = c.cluster(table, k=k, rounds=3, size=size)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows + odd, k, 3, size)


def test_few_and_no_rows(spark, scratch):
    empty = spark.createDataFrame([], SCHEMA)
    assert c.cluster(empty, size=2).count() == 0
    no_id = spark.createDataFrame([(None, [1.0, 2.0], "x", 1)], SCHEMA)
    assert c.cluster(no_id, size=2).count() == 0
    huge = spark.createDataFrame([(1, [1e30, 0.0], "x", 1), (2, [1.0, 2.0], "x", 1)], SCHEMA)
    assert [(r.vec_id, r.cluster, r.distance) for r in c.cluster(huge, size=2).collect()] == [(2, 0, 0)]
    same = spark.createDataFrame([(i, [1.0, 2.0], "x", 1) for i in range(50)], SCHEMA)
    assert {(r.cluster, r.distance) for r in c.cluster(same, size=2).collect()} == {(0, 0)}
