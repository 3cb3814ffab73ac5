"""Bounded k-means against plain rounds in Python integers; the bounds against samples."""
import hashlib
import math
from fractions import Fraction

import numpy as np

from clinloom.llm import drift_clustering as D
from clinloom.llm.vector_blocks import floored

ROWS = [(i, [float((i * 7 + j * j) % 13 - 6) / 5 for j in range(64)]) for i in range(60)]
ODD = [(62, None), (63, [1.0] * 63), (64, [float("nan")] * 64), (65, [1.0] * 63 + [None]), (66, [math.inf] * 64),
       (None, [0.5] * 64), (3, ROWS[3][1]), (3, [9.0] * 64), (70, [1e8] * 64)]
HUGE = [(60, [1e30] * 64), (61, [-1e300] * 64)]


def plain(rows, k, rounds):
    x = [(i, [math.floor(256 * Fraction(v)) for v in e]) for i, e in rows
         if e and len(e) == 64 and all(v is not None and math.isfinite(v) for v in e)]
    c = [v for _, v in sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in x if i is not None)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), j) for j, w in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in x]
        for j in range(len(c)):
            members = [v for (_, v), a in zip(x, own, strict=True) if a == j]
            if members:
                c[j] = [sum(t) // len(members) for t in zip(*members, strict=True)]
    return sorted(((str(i), near(v)[1], near(v)[0]) for i, v in x)), c


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "clash", 7) for i, e in rows], "vec_id long, embedding array<double>, cluster string, v int").repartition(3)


def test_equals_plain_rounds(spark):
    for rows, k in ((ROWS + ODD, 7), (ROWS + ODD + HUGE, 40), (ROWS[:5], 40)):
        got = D.cluster(frame(spark, rows), clusters=k)
        expected, centroids = plain(rows, k, 5)
        assert sorted((str(r.vec_id), r.cluster, int(r.squared)) for r in got.rows.collect()) == expected
        assert got.centroids == centroids
    assert D.cluster(frame(spark, ROWS[:1]).limit(0)).rows.count() == 0


def test_bounds_spare_scans(spark):
    """Vectors in tight groups are not scanned again once their centroids hardly move."""
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(8, 64)) * 4
    rows = [(i, (middle[i % 8] + rng.normal(size=64) * 0.05).tolist()) for i in range(800)]
    got = D.cluster(frame(spark, rows), clusters=8)
    assert got.rows.where("not scanned").count() > 700
    assert sorted((str(r.vec_id), r.cluster, int(r.squared)) for r in got.rows.collect()) == plain(rows, 8, 5)[0]


def test_query_beyond_long(spark, tmp_path):
    frame(spark, ROWS + HUGE).drop("cluster", "v").write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = D.op12_drift_clustering(spark, str(tmp_path)).collect()
    assert len(rows) == 62 and all(r.inertia is not None or r.cluster_inertia is not None or r.distance is not None for r in rows)


def test_drift_holds_and_is_tighter():
    rng = np.random.default_rng(1)
    centre, old = rng.normal(size=(6, 3)) * 3, rng.normal(size=(9, 3)) * 3
    new = old + rng.normal(size=(9, 3)) * rng.choice([0, 0.1, 2], size=(9, 1))
    radius = rng.choice([0.0, 0.3, 2.0], size=6)
    by = D.drift(centre, radius, old, new)
    full = np.linalg.norm(new - old, axis=1)
    assert (by <= full + 1e-12).all() and (by < 0.9 * full).sum() > 10
    for _ in range(400):
        to = rng.normal(size=(6, 3))
        x = centre + to / np.linalg.norm(to, axis=1)[:, None] * (radius * rng.choice([1, 1, rng.uniform()]))[:, None]
        shrunk = np.linalg.norm(x[:, None] - old, axis=2) - np.linalg.norm(x[:, None] - new, axis=2)
        assert (shrunk <= by + 1e-9).all()


def test_exact_products():
    big = np.array([[2**40, -(2**40)], [3, 4]], object)
    assert D.squared(big, big).tolist() == [[0, (2**40 - 3) ** 2 + (2**40 + 4) ** 2]] + [[(2**40 - 3) ** 2 + (2**40 + 4) ** 2, 0]]
    assert D.unpack(D.pack(big), 2).tolist() == big.tolist()
    small = np.array([[-5, 2**30]])
    assert D.unpack(D.pack(small) + D.pack(big), 2).tolist() == [[-5, 2**30], *big.tolist()]
    assert floored(np.array([[-0.001, 1e300]]), 256).tolist() == [[-1, int(1e300) * 256]]
