"""Connected components of a link table, and a bounded filter of ids."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.session import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node in ``links`` (a, b): comp is the smallest node reachable.

    The graph is contracted: each node points to its least neighbour (or itself), the
    pointers are followed to their roots (in doubling steps), and the links between different roots
    are the next, smaller graph.  The smallest node of a component always stays a root,
    so it is the last one.  Minima combine on the map side, and all tables are written, so
    Spark may split a join at a node with very many links."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.where("a <> b").distinct())
    labels = materialize(edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())
    while edges.limit(1).count():
        roots = materialize(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root")))
        while True:
            of_root = roots.select(F.col("a").alias("root"), F.col("root").alias("next"))
            new = materialize(roots.join(of_root, "root").select("a", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("moved")))
            discard(roots)
            roots = new.select("a", "root")
            if not new.where("moved").limit(1).count():
                break
        shorter = edges.join(roots, "a").select("b", F.col("root").alias("ra")).join(
            roots.select(F.col("a").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        old = (edges, labels, roots)
        edges = materialize(shorter.distinct())
        labels = materialize(_renamed(labels, roots.withColumnRenamed("a", "node").withColumnRenamed("root", "comp")))
        for table in old:
            discard(table)
    return labels


def _renamed(labels: DataFrame, names: DataFrame) -> DataFrame:
    """``labels`` whose components have new names (node: the old one)."""
    new = names.select(F.col("node").alias("comp"), F.col("comp").alias("new"))
    return labels.join(new, "comp", "left").select("node", F.coalesce("new", "comp").alias("comp"))


def joined_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, comp) of earlier ``labels`` and new ``links`` together: only links between
    different components are looked at."""
    if labels is None:
        return components(links)
    of = lambda x: labels.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}"))
    named = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = named.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct()
    more = components(between)
    fresh = more.join(labels.select("node"), "node", "left_anti").select("node", "comp")
    return materialize(_renamed(labels, more).union(fresh))


class IdFilter:
    """A bitmap of hashed ids of fixed size: no id of the set is missed, and how many
    others pass depends on the size of the set only.  It thins what a join has to move."""

    BITS, ROW = 1 << 23, 1 << 15

    def __init__(self, ids: DataFrame, column: str):
        at = F.pmod(F.xxhash64(column), F.lit(self.BITS))
        rows = ids.select(at.alias("at")).groupBy((F.col("at") / self.ROW).cast("int").alias("row")).agg(
            F.bitmap_construct_agg(F.col("at") % self.ROW).alias("bits")).collect()  # 256 rows of 4 KB at most
        bits = bytearray(self.BITS // 8)
        for r in rows:
            bits[r.row * self.ROW // 8:(r.row + 1) * self.ROW // 8] = r.bits
        self.bits = bytes(bits)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = np.mod(hashes, self.BITS)
        bits = np.frombuffer(self.bits, np.uint8)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
