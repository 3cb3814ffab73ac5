"""All links of the n-gram Jaccard join, for callers that want more than components.

``jaccard_components`` looks at as few pairs as it can.  Here every link is found: inside a
component, classes of equal sets are dealt to blocks by set size and hash, and two blocks
whose sizes allow links make a tile, so each set is moved once a tile and not once a pair.
A tile is joined by adaptive multi-match prefixes in the order of its own shingle counts, and its
candidates are verified on their whole sets.  Blocks are bounded by ``members`` classes and
``shingles`` shingles (a larger set has a block nearly alone), so a component of any size
is spread over tasks; none is left out.

Links between equal sets are not spelled out: ``jaccard_links`` has the pairs between class
representatives, and ``link_counts`` counts per document with the sizes of the classes.
Both grow with what they return: near copies of which all n are linked make n(n-1)/2 pairs; the
counts move n rows, but compare as many pairs.

Defined results: a null or empty text, or one without words, has no link; a row with a null
doc_id has none and counts for none; repeated rows are documents of their own; texts of any length are whole;
other columns are ignored; an empty table gives an empty one.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import id_text
from clinloom.llm.ngram_join import MOST_MATCHES, PERCENT, WIDTH, Verifier, classes_and_rows, prefix
from clinloom.session import materialize

MEMBERS, SHINGLES = 1024, 2_000_000
TILE = ["component", "la", "ia", "lb", "ib"]


def tiles(classes: DataFrame, percent: int, members: int, shingles: int) -> DataFrame:
    """cls, docs and the tiles (TILE) that a class belongs to, on side 0, 1 or, in a tile of one
    block, both (2).  Linked sets differ in size by 100 / percent at most, so by one level."""
    level = F.floor(F.log("n") / math.log(101 / percent)).cast("int")
    classes = classes.withColumn("level", level)
    groups = materialize(classes.groupBy("component", "level").agg(F.sum("n").alias("n"), F.count("*").alias("k")).select(
        "component", "level", F.greatest(F.ceil(F.col("n") / shingles), F.ceil(F.col("k") / members)).cast("int").alias("parts")))
    below = groups.select("component", (F.col("level") + 1).alias("level"), F.col("parts").alias("below"))
    above = groups.select("component", (F.col("level") - 1).alias("level"), F.col("parts").alias("above"))
    around = materialize(groups.join(below, ["component", "level"], "left").join(above, ["component", "level"], "left"))
    dealt = classes.join(around, ["component", "level"]).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    own, at = F.col("part"), F.col("level")

    def tile(la, ia, lb, ib, side):
        return F.struct(la.alias("la"), ia.alias("ia"), lb.alias("lb"), ib.alias("ib"), side.cast("int").alias("side"))

    def numbers(n):
        return F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    mine = F.transform(numbers(F.col("parts")), lambda j: tile(
        at, F.least(own, j), at, F.greatest(own, j), F.when(own == j, 2).when(own < j, 0).otherwise(1)))
    lower = F.transform(numbers(F.col("below")), lambda j: tile(at - 1, j, at, own, F.lit(1)))
    upper = F.transform(numbers(F.col("above")), lambda j: tile(at, own, at + 1, j, F.lit(0)))
    return dealt.select("cls", "docs", "component", F.explode(F.concat(mine, lower, upper)).alias("t")).select("cls", "docs", "component", "t.*")


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (i, j, shared shingles) of the sets numbered ``left`` with those numbered
    ``right``; if both are the same numbers, each pair once."""
    none = np.empty(0, np.int64)
    if not len(left) or not len(right):
        return none, none, none
    size = np.array(list(map(len, sets)))
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ids = np.split(ids, np.cumsum(size)[:-1])
    asked, token, owner = np.empty(len(sets), np.int64), [], []
    for k, (s, i) in enumerate(zip(sets, ids, strict=True)):
        order, asked[k] = prefix(s, counts[i], 1.0, percent, most)
        token.append(i[order])
        owner.append(np.full(len(order), k))
    token, owner = np.concatenate(token), np.concatenate(owner)
    by = np.argsort(token, kind="stable")
    token, owner = token[by], owner[by]
    row, column = np.full(len(sets), -1), np.full(len(sets), -1)
    row[left], column[right] = np.arange(len(left)), np.arange(len(right))
    met = np.zeros((len(left), len(right)), np.int16)
    for listed in np.split(owner, np.flatnonzero(np.diff(token)) + 1):
        if len(listed) > 1:
            r, c = row[listed], column[listed]
            met[np.ix_(r[r >= 0], c[c >= 0])] += 1
    na, nb = size[left][:, None], size[right][None]
    fits = (met >= np.minimum(asked[left][:, None], asked[right][None])) & (100 * na >= percent * nb) & (100 * nb >= percent * na)
    if np.array_equal(left, right):
        fits = np.triu(fits, 1)
    marked, found = np.zeros(len(counts), bool), []
    for r in np.flatnonzero(fits.any(axis=1)):
        i, partners = left[r], right[np.flatnonzero(fits[r])]
        marked[ids[i]] = True
        starts = np.cumsum([0, *size[partners[:-1]]])
        both = np.add.reduceat(marked[np.concatenate([ids[j] for j in partners])].astype(np.int64), starts)
        marked[ids[i]] = False
        linked = 100 * both >= percent * (size[i] + size[partners] - both)
        found.append((np.full(linked.sum(), i), partners[linked], both[linked]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, none)


def _tiled(docs: DataFrame, width: int, percent: int, most: int, members: int, shingles: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes, rows and the tiles' sets, of the components of more than one class."""
    docs = id_text(docs)
    classes, rows = classes_and_rows(docs, width, percent, most)
    copies = rows.where("doc_id is not null and cls is not null").groupBy("cls").agg(F.count("*").alias("docs"))
    several = classes.groupBy("component").agg(F.count("*").alias("k")).where("k > 1").select("component")
    joined = materialize(classes.join(several, "component").join(copies, "cls"))
    sets = materialize(Verifier(docs, classes, width, percent).sets(joined.select("cls")))
    return classes, rows, tiles(joined, percent, members, shingles).join(sets, "cls")


def _of_tile(t: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    cls, docs, side = (t.column(c).to_numpy() for c in ("cls", "docs", "side"))
    sets = [s.values.to_numpy().view(np.uint64) for s in t.column("shingles")]
    return cls, docs, sets, np.flatnonzero(side != 1), np.flatnonzero(side != 0)


def jaccard_links(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, most: int = MOST_MATCHES,
                  members: int = MEMBERS, shingles: int = SHINGLES) -> DataFrame:
    """class_a, class_b, n_shared, n_union of every link between different sets, each once; a
    class is named by its smallest doc_id, as in ``jaccard_components``."""
    classes, _, tiled = _tiled(docs, width, percent, most, members, shingles)

    def pairs(t: pa.Table) -> pa.Table:
        cls, _, sets, left, right = _of_tile(t)
        i, j, both = block_links(sets, left, right, percent, most)
        n = np.array(list(map(len, sets)), np.int64)
        return pa.table({"a": cls[i], "b": cls[j], "n_shared": both, "n_union": n[i] + n[j] - both})

    found = tiled.groupBy(*TILE).applyInArrow(pairs, "a long, b long, n_shared long, n_union long")
    name = lambda x: classes.select(F.col("cls").alias(x), F.col("rep").alias(f"rep_{x}"))
    named = found.join(name("a"), "a").join(name("b"), "b")
    return named.select(F.least("rep_a", "rep_b").alias("class_a"), F.greatest("rep_a", "rep_b").alias("class_b"), "n_shared", "n_union")


def link_counts(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, most: int = MOST_MATCHES,
                members: int = MEMBERS, shingles: int = SHINGLES) -> DataFrame:
    """doc_id, component_id, class_id, n_links of every document: the documents linked with
    it, those of its own class included.  Tiles answer with a row per class, not per pair."""
    classes, rows, tiled = _tiled(docs, width, percent, most, members, shingles)

    def counts(t: pa.Table) -> pa.Table:
        cls, size, sets, left, right = _of_tile(t)
        i, j, _ = block_links(sets, left, right, percent, most)
        links = np.zeros(len(cls), np.int64)
        np.add.at(links, i, size[j])
        np.add.at(links, j, size[i])
        some = links > 0
        return pa.table({"cls": cls[some], "links": links[some]})

    others = tiled.groupBy(*TILE).applyInArrow(counts, "cls long, links long").groupBy("cls").agg(F.sum("links").alias("others"))
    own = rows.where("doc_id is not null and cls is not null").groupBy("cls").agg((F.count("*") - 1).alias("copies"))
    of_class = materialize(classes.select("cls", "rep", "component").join(own, "cls").join(others, "cls", "left").select(
        "cls", "rep", "component", (F.col("copies") + F.coalesce("others", F.lit(0))).alias("links")))
    known = F.col("doc_id").isNotNull()
    return rows.join(of_class, "cls", "left").select(
        "doc_id", F.when(known, F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(known, F.coalesce("rep", "doc_id")).alias("class_id"),
        F.when(known, F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"))
