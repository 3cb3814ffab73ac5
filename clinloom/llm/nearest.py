"""Approximate nearest neighbours by int8 product tiles with error bounds.

Each vector x is held as s * q with q int8 and s = max|x| / 127; its error e = x - s * q
is known.  A tile multiplies the int8 blocks (as float32, in which these sums are
exact); |x.y - sx sy qx.qy| <= |sx qx||ey| + |ex||sy qy| + |ex||ey| bounds every product.
Pairs whose upper bound reaches the k-th largest lower bound of their query in the tile
are computed again from the original vectors in double precision; heaps keep the k best.
As the bounds hold, no neighbour is lost: recall is 1.

Defined results: see ``vector_blocks``; zero vectors take no part either; ties go to the
smaller vec_id; with fewer than k candidates all are returned; a score that leaves the range
of doubles is infinite.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import table
from clinloom.llm.vector_blocks import clean, search


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32), scale, norm of what they stand for, norm of the error."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    held = q * scale[:, None]
    return q.astype(np.float32), scale, np.linalg.norm(held, axis=1), np.linalg.norm(x - held, axis=1)


def nearest_tile(k: int):
    def tile(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray) -> Iterator[tuple[int, list[tuple]]]:
        with np.errstate(over="ignore", invalid="ignore"):
            yield from scored(qid, q, cid, c, *quantise(c))

    def scored(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, cq: np.ndarray, cs: np.ndarray,
               cn: np.ndarray, ce: np.ndarray) -> Iterator[tuple[int, list[tuple]]]:
        for lo in range(0, len(q), 256):
            ids, part = qid[lo:lo + 256], q[lo:lo + 256]
            qq, qs, qn, qe = quantise(part)
            near = (qq @ cq.T).astype(np.float64) * qs[:, None] * cs
            err = (qn[:, None] * ce + qe[:, None] * (cn + ce)) * (1 + 1e-9) + 1e-12 * qn[:, None] * cn
            own = ids[:, None] == cid
            low = np.where(own | ~np.isfinite(near - err), -np.inf, near - err)
            kth = np.partition(low, len(cid) - k, axis=1)[:, len(cid) - k] if len(cid) > k else np.full(len(ids), -np.inf)
            rows, cols = np.nonzero(~(near + err < kth[:, None]) & ~own)  # also where the bound is no number
            ends = np.searchsorted(rows, np.arange(len(ids) + 1))
            for i, query in enumerate(ids.tolist()):
                at = cols[ends[i]:ends[i + 1]]
                score = np.cumsum(c[at] * part[i], axis=1)[:, -1]  # summed in order: equal vectors, equal scores
                best = np.lexsort((cid[at], -score))[:k]
                if len(best):
                    yield query, list(zip((-score[best]).tolist(), cid[at][best].tolist(), strict=True))

    return tile


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, block_rows: int = 2048,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query."""
    usable = clean(vectors, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    return search(usable, is_query, k, block_rows, "double", nearest_tile(k))


def op6_nearest(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
