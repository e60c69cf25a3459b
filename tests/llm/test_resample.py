import math

import numpy as np
from pyspark.sql import functions as F

from lodestrata.llm import resample as s

LABELS = "doc_id long, quality int, toxic int"


def corpus(prose, n):
    rows = [(i, prose(60, i) if i % 3 else " ".join(f"zq{(i * k) % 97}" for k in range(60))) for i in range(n)]
    return rows, [(i, int(i % 3 > 0), 0) for i in range(0, n, 2)]


def test_against_plain_counting(spark, documents, prose):
    rows, labels = corpus(prose, 90)
    rows += [(900, None), (901, ""), (902, "?"), (1, rows[1][1])]
    labels += [(None, 1, 0), (3, None, 0), (5, 1, 0), (5, 0, 0), (7777, 1, 0)]
    docs, marks = documents(rows), spark.createDataFrame(labels, LABELS)
    found = s.resample(docs, marks, keep=0.5).collect()
    assert len(found) == len(rows)

    def count(texts):
        out = np.zeros(s.BUCKETS)
        for t in texts:
            np.add.at(out, s.buckets_of([t])[0], 1)
        return out

    good = {i for i, q, _ in labels if q == 1 and i is not None} - {5}
    raw, target = count(t for _, t in rows), count(t for i, t in rows if i in good)
    assert (s.counted(docs) == raw).all() and (s.target_counts(docs, marks) == target).all()
    ratio = np.log((target + 1) / (target + 1).sum()) - np.log((raw + 1) / (raw + 1).sum())
    texts = dict(rows)
    for r in found:
        b = s.buckets_of([texts[r.doc_id]])[0]
        assert r.n_grams == len(b)
        assert math.isclose(r.log_weight, s.SHARPNESS * ratio[b].mean() if len(b) else 0.0, abs_tol=1e-9)
    keys = sorted((r.key for r in found), reverse=True)
    edge = keys[math.ceil(len(rows) / 2) - 1]
    assert all(r.selected == (r.key >= edge) for r in found)
    by = {r.doc_id: r.log_weight for r in found}
    assert np.mean([by[i] for i in range(90) if i % 3]) > np.mean([by[i] for i in range(0, 90, 3)]) + 1


def test_boundary(spark, monkeypatch):
    monkeypatch.setattr(s, "RANGES", 4)
    rng = np.random.default_rng(1)
    values = [*rng.normal(size=300).tolist(), *[0.25] * 50, 1e300, -1e300, 0.1, math.nextafter(0.1, 1)]
    keyed = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 100, 150, 200, len(values)):
        assert s.boundary(keyed, k) == ordered[k - 1]


def test_noise_is_gumbel(documents):
    rows = documents([(i, "w") for i in range(2000)])
    keys = [r.key for r in s.weigh(rows, np.zeros(s.BUCKETS)).collect()]
    assert abs(np.mean(keys) - 0.5772) < 0.12 and abs(np.std(keys) - 1.2825) < 0.12


def test_edges(spark, documents, prose):
    none = spark.createDataFrame([], LABELS)
    assert s.resample(documents([]), none).count() == 0
    found = s.resample(documents([(i, prose(5, i)) for i in range(10)]), none, keep=0.3)
    assert found.where(F.col("log_weight") == 0).count() == 10 and found.where("selected").count() == 3


def test_the_kept_share_is_that_of_good_labels(spark, documents, prose):
    rows, _ = corpus(prose, 60)
    docs = documents(rows)

    def kept(labels):
        return s.resample(docs, spark.createDataFrame(labels, LABELS)).where("selected").count()

    half = [(i, int(i % 2), 0) for i in range(40)]
    assert kept(half) == 30
    assert kept([*half, (1, 0, 0), (None, 1, 0), (50, None, 0)]) == math.ceil(60 * 19 / 40)
    assert kept([(i, 0, 0) for i in range(9)]) == 0
    assert kept([]) == 60
