"""Blocks of vectors and their tiles, for searches of a stated query set.

Vectors are dealt by a hash of their id into blocks of about ``block_rows``; each query
block meets each candidate block in one row (a tile) of an equi-join on the block
number.  A tile is worked on by itself, so memory is bounded by two blocks, and tiles of
one candidate block can be on any executor.

Rows that repeat a vec_id count as one vector, the smallest of them in array order.  A
null vec_id, a null or empty vector and one with a null or non-finite component take no part.
Vectors of different lengths are never compared.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import map_arrow
from clinloom.session import materialize, release_shuffles


WIDEST = 10**38 - 1  # integer scores beyond it count as it


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): one row per id, usable vectors only, as doubles."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where("vec_id is not null and size(v) > 0").where(finite)
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def floored(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, as Python integers where they leave 32 bits."""
    if values.size and np.abs(values).max() * float(scale) >= 2.0**31:
        exact = [math.floor(Fraction(v) * scale) for v in values.ravel().tolist()]  # beyond doubles too
        return np.array(exact, object).reshape(values.shape)
    return np.floor(values * scale).astype(np.int64)


def _blocks(rows: DataFrame, count: int, block_rows: int, prefix: str) -> tuple[DataFrame, int]:
    n = max(1, -(-count // block_rows))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    packed = rows.groupBy(F.size("v").alias("dim"), block.alias(f"{prefix}block")).agg(F.collect_list(F.struct("vec_id", "v")).alias("r"))
    return packed.select("dim", f"{prefix}block", F.col("r.vec_id").alias(f"{prefix}ids"), F.flatten("r.v").alias(f"{prefix}v")), n


def search(vectors: DataFrame, is_query: Column, k: int, block_rows: int, score_type: str,
           tile: Callable[..., Iterator[tuple[int, list[tuple]]]], grow: int = 0) -> DataFrame:
    """The ``k`` best of each query over all tiles: query_id, rank, vec_id, score (an
    integer score that ``score_type`` cannot hold is ranked and then null).

    ``tile(query ids, queries, candidate ids, candidates)`` yields (query id,
    [(-score, vec_id), ...]) with at least the tile's k best of each query.  With ``grow`` it
    gets the task's best so far as well, as {query id: such a list}, and may leave out what is
    behind them; blocks of at most 256 dimensions then have up to ``grow`` times the rows (those
    of candidates if there are 64 blocks and more), so queries are copied less often."""
    rows = materialize(vectors)
    queries = rows.where(is_query)
    count, more = rows.count(), 1
    if grow:
        release_shuffles(vectors.sparkSession)
        more = max(1, min(grow, 256 // max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)))
    cand, n = _blocks(rows, count, block_rows * max(1, min(more, count // (64 * block_rows))), "c")
    asked, _ = _blocks(queries, queries.count(), block_rows * more, "q")
    tiles = asked.withColumn("cblock", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(cand, ["dim", "cblock"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}

        def rows_out() -> pa.RecordBatch:
            flat = [(q, v, -s) for q, r in best.items() for s, v in r]
            best.clear()
            kind = pa.float64()
            if score_type != "double":
                kind, flat = pa.decimal128(38, 0), [(q, v, Decimal(s)) for q, v, s in flat]
            return pa.record_batch([pa.array([f[i] for f in flat], t) for i, t in enumerate((pa.int64(), pa.int64(), kind))],
                                   names=["query_id", "vec_id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                dim, qid, q, cid, c = (b.column(b.schema.get_field_index(x))[i] for x in ("dim", "qids", "qv", "cids", "cv"))
                d = dim.as_py()
                qi, ci = (x.values.to_numpy() for x in (qid, cid))
                known = (best,) if grow else ()
                for query, found in tile(qi, q.values.to_numpy().reshape(-1, d), ci, c.values.to_numpy().reshape(-1, d), *known):
                    old = best.get(query)
                    best[query] = heapq.nsmallest(k, found + old if old else found)
                if len(best) * k > 1_000_000:
                    yield rows_out()
        if best:
            yield rows_out()

    held = "double" if score_type == "double" else "decimal(38,0)"
    found = map_arrow(tiles.select("dim", "qids", "qv", "cids", "cv"), run, f"query_id long, vec_id long, score {held}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.expr(f"try_cast(score AS {score_type})").alias("score")))
