"""Vector searches against brute force."""
import math
import time
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinloom.llm import bit_sliced, nearest
from clinloom.llm.vector_blocks import clean, search

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[50:200] = x[50]  # a large group of equal vectors
    out = [(i, v.tolist()) for i, v in enumerate(x)]
    out += [(400, None), (420, [1.0, None] + [0.0] * 14), (440, [NAN] + [0.0] * 15), (460, [INF] * 16), (480, [0.0] * 16), (500, []), (None, [1.0] * 16), (3, x[3].tolist())]
    return out


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], "vec_id long, embedding array<float>, v string, rank string").repartition(4)


def brute(rows, k, step, integer):
    use = {i: np.array(v, np.float64) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and (integer or np.any(v))}
    ids = np.array(sorted(use))
    x = np.array([use[i] for i in ids])
    x = np.floor(1024 * x).astype(np.int64) if integer else x
    out = set()
    for q in ids[ids % step == 0]:
        s = np.cumsum(x * x[ids == q], axis=1)[:, -1]  # summed in the operator's order
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out |= {(int(q), r + 1, int(ids[j]), s[j].item()) for r, j in enumerate(order)}
    return out


@pytest.mark.parametrize("block_rows", [64, 4096])
def test_nearest(vectors, rows, block_rows):
    got = nearest.nearest(vectors, F.col("vec_id") % 20 == 0, 20, block_rows)
    assert {tuple(r) for r in got.collect()} == brute(rows, 20, 20, False)


@pytest.mark.parametrize("drop", [0, 3, 6])
def test_bit_sliced(vectors, rows, drop):
    got = bit_sliced.top_k(vectors, F.col("vec_id") % 20 == 0, 10, drop, 100)
    assert {tuple(r) for r in got.collect()} == brute(rows, 10, 20, True)


def test_few_candidates_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    ask = F.col("vec_id") == 0
    assert [tuple(r) for r in nearest.nearest(few, ask).collect()] == [(0, 1, 1, 11.0)]
    assert [tuple(r) for r in bit_sliced.top_k(few, ask).collect()] == [(0, 1, 1, 11 * 1024 * 1024)]
    assert nearest.nearest(few.limit(0), ask).count() == bit_sliced.top_k(few.limit(0), ask).count() == 0


def test_large_components(spark):
    """Scores beyond 64 bits are exact inside and null outside; none wraps."""
    rng = np.random.default_rng(7)
    x = [[float(v) for v in rng.integers(-5, 6, 16) * 10.0**rng.integers(0, e, 16)] for e in (1, 1, 4, 7, 7, 12, 12, 30) for _ in range(6)]
    x += [x[20]] * 3 + [[1e300] * 16, [-1e300] * 16]
    rows = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = bit_sliced.top_k(rows, F.col("vec_id") % 4 == 0, 10, 3, 16).collect()
    whole = [[math.floor(1024 * Fraction(v)) for v in r] for r in x]
    expected = []
    limit = 10**38 - 1
    for q in range(0, len(x), 4):
        s = [(min(limit, max(-limit, sum(a * b for a, b in zip(whole[q], w, strict=True)))), j) for j, w in enumerate(whole) if j != q]
        best = sorted(s, key=lambda t: (-t[0], t[1]))[:10]
        expected += [(q, r + 1, j, v if -2**63 <= v < 2**63 else None) for r, (v, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(expected)
    near = nearest.nearest(rows.where("vec_id < 48"), F.col("vec_id") % 4 == 0, 10, 16).collect()
    exact = np.array(x[:48])
    for r in near:
        assert r.score == np.cumsum(exact[r.query_id] * exact[r.vec_id])[-1]
    assert nearest.nearest(rows, F.col("vec_id") % 4 == 0, 10, 16).count() == 10 * len(range(0, len(x), 4))


def test_slices_add_exactly():
    rng = np.random.default_rng(4)
    x, w = rng.integers(-700, 700, (130, 5)), rng.integers(-900, 900, (7, 5))
    b = bit_sliced.SlicedBlock(x, 2)
    sums = b.sums(w)
    bits = np.array([[bit_sliced.from_bitmap(s, 130)] for s in sums])[:, 0]
    value = sum(bits[i].astype(np.int64) << i for i in range(len(bits))) - (1 << (len(bits) - 1))
    assert (value == w @ (x >> 2).T).all()


def exact_best(qid, q, cid, c, k):
    """Brute force over integers: {query id: [(-score, vec_id), ...]}."""
    w, x = (np.floor(1024 * v).astype(np.int64) for v in (q, c))
    out = {}
    for i, a in zip(qid.tolist(), w, strict=True):
        s = (x * a).sum(axis=1)
        out[i] = [(-int(s[j]), int(cid[j])) for j in np.lexsort((cid, -s)) if cid[j] != i][:k]
    return out


@pytest.mark.parametrize("n, m, d, scale", [(700, 300, 64, 0.125), (500, 70, 20, 1.0), (130, 20, 65, 40.0), (9000, 5, 3, 0.3), (200, 40, 1, 1.0), (300, 60, 33, 1e4)])
def test_tiles_with_the_best_so_far(n, m, d, scale):
    """Tiles that know the best of the tiles before give the same as one over all rows,
    with equal vectors, a zero vector and a much longer one, too."""
    rng = np.random.default_rng(n)
    c, cid = rng.normal(size=(n, d)) * scale, rng.permutation(n)
    c[n // 2:n // 2 + 30] = c[0]
    c[3], c[5] = 0, c[5] * 6
    expected = exact_best(cid[:m], c[:m], cid, c, 10)
    for drop in (0, 3):
        best, tile = {}, bit_sliced.sliced_tile(10, drop)
        for lo in range(0, n, n // 3):
            for i, found in tile(cid[:m], c[:m], cid[lo:lo + n // 3], c[lo:lo + n // 3], best):
                best[i] = sorted(best.get(i, []) + found)[:10]
        assert best == expected


def test_rows_behind_the_best_so_far_are_left_out():
    rng = np.random.default_rng(6)
    x, ids = rng.normal(size=(3000, 64)), np.arange(3000)
    all_best = exact_best(ids[:50], x[:50], ids, x, 10)
    found = dict(bit_sliced.sliced_tile(10, 3)(ids[:50], x[:50], ids, x, all_best))
    assert sum(map(len, found.values())) <= 500 and all(set(f) <= set(all_best[i]) for i, f in found.items())
    beyond = {i: [(-10**38, -j) for j in range(10)] for i in range(50)}
    assert not dict(bit_sliced.sliced_tile(10, 3)(ids[:50], x[:50], ids, x, beyond))


def test_a_tile_takes_few_bitmap_operations():
    """In the time of a XOR of words; with a ripple for each set bit of a weight it was 2,300 a pair."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4096 + 768, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(len(x))
    a, b, c = (np.zeros(8192, np.uint64) for _ in range(3))

    def least(run):
        times = []
        for _ in range(3):
            start = time.thread_time()
            run()
            times.append(time.thread_time() - start)
        return min(times)

    word = least(lambda: [np.bitwise_xor(a, b, out=c) for _ in range(500)]) / 500 / 8192
    tile = least(lambda: list(bit_sliced.sliced_tile(10, 3)(ids[4096:], x[4096:], ids[:4096], x[:4096], {})))
    assert tile / (768 * 4096) < 600 * word


def test_larger_blocks_give_the_same(spark, vectors, rows):
    got = search(clean(vectors), F.col("vec_id") % 20 == 0, 10, 2, "long", bit_sliced.sliced_tile(10, 3), grow=3)  # 200 blocks of 2 rows
    assert {tuple(r) for r in got.collect()} == brute(rows, 10, 20, True)


def test_error_bounds_hold():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(50, 32)) * rng.uniform(0.01, 100, (50, 1)), rng.normal(size=(60, 32))
    (xq, xs, xn, xe), (yq, ys, yn, ye) = nearest.quantise(x), nearest.quantise(y)
    near = (xq @ yq.T) * xs[:, None] * ys
    assert (np.abs(near - x @ y.T) <= xn[:, None] * ye + xe[:, None] * (yn + ye) + 1e-9).all()
