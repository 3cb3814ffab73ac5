"""Exact k-means on integer vectors with geometrically tightened bounds.

Lloyd's rounds assign every vector to its nearest centroid and move the centroids to the
floored means.  A vector keeps a lower bound of its distance to all centroids but its own.  When
the centroids have moved, the vector's exact distance to its own one is compared with that
bound, and only if it isn't smaller (the vector is ambiguous) are all centroids scanned.

*Loosening the bounds.*  A lower bound must shrink by as much as a distance may: for a
centroid that moves from p to q, by the largest |x - p| - |x - q| over the vectors x of a cluster.
These lie in a sphere around the cluster's centroid.  In the plane of its centre, p and q, the
points where that difference exceeds 2a lie within a branch of a hyperbola around q, and so
within the cone between its asymptotes, whose tip is the middle of p and q and whose half angle
is acos(2a / |q - p|).  A sphere that reaches to the angle t from the direction of the move
stays out of the cone of that angle, so the difference is at most |q - p| cos t.  Spheres
beside or behind a centroid thus lose far less than its whole drift |q - p|, often nothing.

*On Spark.*  Vectors lie in a written table (id, packed components, cluster, bound).  A round is
one pass over it, which writes the next table; each task adds its counts, sums and radii per
cluster as a few extra rows, and aggregates of those (clusters x dimensions rows) are all that
the driver sees.  Centroids travel in the tasks.  Tables of earlier rounds are removed.

Arithmetic is exact: products by float64 where they stay below 2**53, by 64-bit integers below
2**62, and by Python's integers beyond.  Bounds have a margin above the rounding of doubles.

Defined results: a vector of another length, null, or with a null or non-finite component takes no
part; repeated rows are vectors of their own; a null vec_id is clustered but never a starting
centroid; of starting candidates with equal hashes the least vector comes first; fewer vectors
than centroids start fewer; a distance or sum beyond a long is null; other columns are
ignored; an empty table gives an empty one.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom.llm.common import arrow_columns, map_arrow, table
from clinloom.llm.vector_blocks import floored
from clinloom.session import discard, materialize

CLUSTERS, ROUNDS, SCALE, DIM, SEED = 40, 5, 256, 64, "2"
LONG = 2**63
MOST = 1  # place of the largest squared distance in a cluster's totals
STATE = "vec_id long, v binary, cluster int, bound double, squared string, scanned boolean, part binary"


# ---- exact arithmetic on integer rows -------------------------------------------------

def pack(rows: np.ndarray) -> list[bytes]:
    """Rows as bytes: a zero and 32-bit integers where they fit, else a one and decimals."""
    if rows.dtype != object:
        return [b"\0" + r.tobytes() for r in rows.astype("<i4")]
    return [b"\1" + b",".join(b"%d" % x for x in r) for r in rows.tolist()]


def unpack(packed: list[bytes], dim: int) -> np.ndarray:
    if all(p[0] == 0 for p in packed):
        raw = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 4 * dim + 1)[:, 1:]
        return np.ascontiguousarray(raw).view("<i4").astype(np.int64)
    return np.array([np.frombuffer(p, "<i4", offset=1).tolist() if p[0] == 0 else list(map(int, p[1:].split(b",")))
                     for p in packed], object).reshape(-1, dim)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to those of c, exactly."""
    top = max((int(np.abs(a).max()) if a.size else 0) for a in (x, c))
    room = 4 * x.shape[1] * (top + 1) ** 2
    if room < 2**53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    kind = np.int64 if room < 2**62 else object
    a, b = x.astype(kind), c.astype(kind)
    return np.stack([((a - row) ** 2).sum(1) for row in b], axis=1) if len(b) else np.zeros((len(a), 0), kind)


def root(s: np.ndarray) -> np.ndarray:
    if s.dtype != object:
        return np.sqrt(s.astype(np.float64))
    return np.array([math.sqrt(v) if v < 2**1000 else float(math.isqrt(v)) for v in s.tolist()])


# ---- bounds ----------------------------------------------------------------------------

def drift(centre: np.ndarray, radius: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """(clusters, centroids): by how much the distance to a centroid that moves from ``old`` to
    ``new`` may shrink for points in each sphere (centre, radius); never more than the move."""
    move = new - old
    to = centre[:, None, :] - (old / 2 + new / 2)[None]
    with np.errstate(all="ignore"):  # what leaves the range of doubles ends in a full scan
        length, far = np.linalg.norm(move, axis=1), np.linalg.norm(to, axis=2)
        cos_centre = np.clip(np.einsum("acd,cd->ac", to, move) / (far * length), -1, 1)
        sin_half = radius[:, None] / far
    inside = ~(sin_half < 1) | ~np.isfinite(far) | ~np.isfinite(cos_centre)  # the sphere holds the cones' tip, or unknown
    angle = np.arccos(cos_centre) - np.arcsin(np.where(inside, 0, sin_half))
    share = np.where(inside, 1.0, np.where(angle > 0, np.maximum(np.cos(np.maximum(angle, 0)), 0), 1.0))
    with np.errstate(invalid="ignore"):
        return np.where(length == 0, 0.0, np.minimum(share + 1e-9, 1.0) * length)


def loosening(centre: np.ndarray, radius: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much the bound of each cluster's vectors shrinks: the most over the other centroids."""
    by = drift(centre, radius, old, new)
    np.fill_diagonal(by, 0.0)
    return by.max(axis=1, initial=0.0) * (1 + 1e-9) + 1e-9


# ---- one round ---------------------------------------------------------------------------

@dataclass
class Step:
    """What a task needs for one pass: the centroids now, and for all but the first pass by
    how much the bound of each cluster's vectors shrinks."""

    centroids: np.ndarray
    shrink: np.ndarray | None = None
    dim: int = DIM

    def assign(self, x: np.ndarray, cluster: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """cluster, squared distance, bound, and which rows were scanned."""
        n, c = len(x), self.centroids
        if self.shrink is None:
            open_, near = np.ones(n, bool), None
        else:
            near = np.zeros(n, object if x.dtype == object or c.dtype == object else np.int64)
            for a in np.unique(cluster):
                own = cluster == a
                near[own] = squared(x[own], c[a:a + 1])[:, 0]
            bound = bound - self.shrink[cluster]
            open_ = ~(root(near) * (1 + 1e-12) < bound * (1 - 1e-12))
        if open_.any():
            all_ = squared(x[open_], c)
            best = np.argmin(all_, axis=1)  # ties: the smaller number
            least = all_[np.arange(len(all_)), best]
            rest = all_.copy()
            rest[np.arange(len(all_)), best] = rest.max() + 1 if rest.size else 0
            second = root(rest.min(axis=1)) if c.shape[0] > 1 else np.full(len(best), np.inf)
            near = least if near is None else near
            cluster, bound = cluster.copy(), bound.copy()
            near[open_], cluster[open_], bound[open_] = least, best, second
        return cluster, near, bound, open_


@dataclass
class Totals:
    """Per cluster: vectors, sum of the components, largest and summed squared distance."""

    n: dict = field(default_factory=dict)

    def add(self, cluster: np.ndarray, x: np.ndarray, near: np.ndarray) -> None:
        for a in np.unique(cluster).tolist():
            own = cluster == a
            count, total, most, inertia = self.n.get(a, (0, 0, 0, 0))
            part = x[own].sum(axis=0)
            d = near[own]
            # Python integers from here on: no sum over rows can wrap
            self.n[a] = (count + int(own.sum()), [p + int(q) for p, q in zip(total or [0] * x.shape[1], part, strict=True)],
                         max(most, int(d.max())), inertia + sum(map(int, d)) if d.dtype == object else inertia + int(d.astype(object).sum()))

    def rows(self) -> Iterator[tuple[int, bytes]]:
        for a, (count, total, most, inertia) in self.n.items():
            yield a, ",".join(map(str, [count, most, inertia, *total])).encode()


def one_pass(state: DataFrame, step: Step) -> DataFrame:
    """STATE of the next round: a row per vector, and per task a row per cluster (``part``: its
    count, largest and summed squared distance and component sums)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals()
        names = ["vec_id", "v", "cluster", "bound", "squared", "scanned", "part"]
        for b in batches:
            for lo in range(0, b.num_rows, 8192):
                ids, v, cluster, bound = arrow_columns(b.slice(lo, 8192), "vec_id", "v", "cluster", "bound")
                x = unpack(v.to_pylist(), step.dim)
                c, near, low, scanned = step.assign(x, cluster.to_numpy(), bound.to_numpy())
                totals.add(c, x, near)
                yield pa.record_batch([ids, v, pa.array(c.astype(np.int32)), pa.array(low), pa.array([str(d) for d in near.tolist()]),
                                       pa.array(scanned), pa.nulls(len(x), pa.binary())], names=names)
        rows = list(totals.rows())
        if rows:
            k = len(rows)
            yield pa.record_batch([pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array([a for a, _ in rows], pa.int32()), pa.nulls(k, pa.float64()),
                                   pa.nulls(k, pa.string()), pa.nulls(k, pa.bool_()), pa.array([p for _, p in rows], pa.binary())], names=names)

    return map_arrow(state.select("vec_id", "v", "cluster", "bound"), run, STATE)


def totals_of(state: DataFrame) -> dict[int, tuple[int, int, int, list[int]]]:
    """cluster -> vectors, largest and summed squared distance, component sums.  A cluster's
    rows, one of each task, are added up as a stream; the driver gets a row per cluster."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[int]] = {}
        for b in batches:
            for a, part in zip(*(c.to_pylist() for c in arrow_columns(b, "cluster", "part")), strict=True):
                new = list(map(int, part.split(b",")))
                old = by.get(a)
                by[a] = new if old is None else [x + y if i != MOST else max(x, y) for i, (x, y) in enumerate(zip(old, new, strict=True))]
        yield pa.record_batch([pa.array(list(by), pa.int32()), pa.array([",".join(map(str, v)).encode() for v in by.values()], pa.binary())], names=["cluster", "part"])

    parts = state.where("part is not null").select("cluster", "part").repartition("cluster")
    rows = {r.cluster: list(map(int, bytes(r.part).split(b","))) for r in map_arrow(parts, add, "cluster int, part binary").collect()}
    return {a: (r[0], r[MOST], r[2], r[3:]) for a, r in rows.items()}


# ---- the whole -----------------------------------------------------------------------------

def usable(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """STATE before the first round: the vectors that take part, scaled and floored."""
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")).where((F.size("x") == dim) & finite)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, x = arrow_columns(b, "vec_id", "x")
            v = floored(x.flatten().to_numpy().reshape(-1, dim), scale)
            yield pa.record_batch([ids, pa.array(pack(v), pa.binary()), pa.array(np.zeros(len(v), np.int32)), pa.array(np.zeros(len(v)))],
                                  names=["vec_id", "v", "cluster", "bound"])

    return map_arrow(rows, run, "vec_id long, v binary, cluster int, bound double")


def starting(state: DataFrame, clusters: int, dim: int, seed: str) -> np.ndarray:
    """The vectors of the smallest hashes of ``seed:vec_id``."""
    named = state.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256))
    first = named.select("h", "v").orderBy("h", "v").limit(clusters).collect()
    return unpack([bytes(r.v) for r in first], dim)


@dataclass
class Clustering:
    """``rows``: vec_id, cluster, squared (decimal text), scanned (whether the last pass had
    to look at all centroids); the final centroids; per cluster its inertia."""

    rows: DataFrame
    centroids: list[list[int]]
    inertia: dict[int, int]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, seed: str = SEED) -> Clustering:
    state = materialize(usable(vectors, dim, scale))
    c = starting(state, clusters, dim, seed)
    if not len(c):
        none = state.limit(0).select("vec_id", "cluster", F.lit("0").alias("squared"), F.lit(True).alias("scanned"))
        return Clustering(none, [], {})
    step = Step(c, None, dim)
    for _ in range(rounds):
        done = materialize(one_pass(state, step))
        discard(state)
        sums = totals_of(done)
        new = np.array([[s // sums[a][0] for s in sums[a][3]] if a in sums else [int(v) for v in c[a]] for a in range(len(c))], object)
        if max(abs(int(v)) for r in new for v in r) < 2**31:
            new = new.astype(np.int64)
        old = c.astype(np.float64)
        radius = root(np.array([sums[a][1] if a in sums else 0 for a in range(len(c))], object)) * (1 + 1e-12)
        beyond = object in (c.dtype, new.dtype)  # doubles don't hold such centroids: all vectors are scanned
        step = Step(new, np.full(len(c), np.inf) if beyond else loosening(old, radius, old, new.astype(np.float64)), dim)
        state, c = done.where("part is null"), new
    last = materialize(one_pass(state, step))
    discard(state)
    return Clustering(last.where("part is null").select("vec_id", "cluster", "squared", "scanned"), [[int(v) for v in r] for r in c],
                      {a: s[2] for a, s in totals_of(last).items()})


def op12_drift_clustering(spark, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "embeddings"))
    fits = lambda v: v if -LONG <= v < LONG else None
    named = [(a, fits(found.inertia.get(a, 0)), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for a, c in enumerate(found.centroids)]
    of_cluster = spark.createDataFrame(named, T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
                                                            T.StructField("centroid_sha256", T.StringType())]))
    total = fits(sum(found.inertia.values()))
    return found.rows.join(F.broadcast(of_cluster), "cluster").select(  # a row per centroid
        "vec_id", "cluster", F.expr("try_cast(squared as bigint)").alias("distance"), "cluster_inertia",
        F.lit(total).cast("long").alias("inertia"), "centroid_sha256")
