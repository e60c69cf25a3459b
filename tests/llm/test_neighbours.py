import math

import numpy as np
from pyspark.sql import functions as F

from lodestrata.llm import neighbours as n

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0, 1) for i, v in rows], SCHEMA)


def brute(rows, asks, k=20):
    good = [(i, np.array(np.array(v, np.float32), np.float64)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if asks(q):
            out[q] = sorted(((-float((w * v).sum()), i) for i, w in good if i != q))[:k]
    return out


def vectors(m, dim, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dim))
    x = centres[rng.integers(0, 30, m)] + rng.normal(size=(m, dim))
    return (x * rng.uniform(0.5, 2, (m, 1))).astype(np.float32)


def found_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def recall(rows, df, asks):
    want, got = brute(rows, asks), found_of(df)
    assert set(want) == set(got)
    hit = total = 0
    for q, best in want.items():
        assert [r for r, _, _ in got[q]] == list(range(1, len(best) + 1))
        assert [(-s, i) for _, i, s in got[q]] == sorted((-s, i) for _, i, s in got[q])
        exact = {i: -s for s, i in brute(rows, lambda x: x == q, len(rows))[q]}
        assert all(abs(exact[i] - s) < 1e-9 for _, i, s in got[q])
        hit += len({i for _, i, _ in got[q]} & {i for _, i in best})
        total += len(best)
    return hit / total


def test_recall_over_several_blocks(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(1500, 24))]
    df = frame(spark, rows)
    for options in ({}, {"vectors_per_block": 400, "queries_per_block": 20}):
        assert recall(rows, n.search(df, F.col("vec_id") % 20 == 0, **options), lambda i: i % 20 == 0) >= 0.9


def test_copies_and_ties(spark):
    v = vectors(60, 8, 1)
    rows = [(i, v[0].tolist()) for i in range(300)] + [(300 + i, x.tolist()) for i, x in enumerate(v[1:])]
    rows += [(5, v[0].tolist())]
    got = found_of(n.search(frame(spark, rows), F.col("vec_id") == 0))[0]
    assert sorted(i for _, i, s in got if abs(s - got[0][2]) < 1e-12)[:1] == [got[0][1]]
    copies = [i for _, i, _ in got if i < 300]
    assert copies == list(range(1, len(copies) + 1)) and len(got) == 20


def test_odd_vectors_take_no_part(spark):
    good = [(i, x.tolist()) for i, x in enumerate(vectors(15, 4, 2))]
    odd = [(100, None), (101, []), (120, [0.0] * 4), (140, [1.0, None, 1.0, 1.0]), (160, [1.0, float("nan"), 0.0, 0.0]),
           (180, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (200, [1.0] * 3)]
    got = found_of(n.search(frame(spark, good + odd), F.col("vec_id") % 20 == 0))
    assert set(got) == {0} and len(got[0]) == 14
    assert [i for _, i, _ in got[0]] == [i for _, i in brute(good, lambda i: i == 0)[0]]


def test_empty_and_alone(spark):
    assert n.search(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert n.search(frame(spark, [(20, [1.0, 2.0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert n.search(frame(spark, [(1, [1.0, 2.0])]), F.col("vec_id") % 20 == 0).count() == 0
