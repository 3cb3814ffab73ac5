"""Interpolated modified Kneser-Ney model of word 3-grams, held and moved in packed form.

A word is a hash of 21 bits and an n-gram the words' hashes behind each other, so contexts
and suffixes are bits of a key.  Keys are dealt into ranges by a hash of their context:
everything that a context's sums need lies in one range.  What moves between tasks are not
rows of keys but sorted arrays of them, as differences in byte planes under zstandard, at
four to six bytes a key.

Training counts 3-grams per task, adds up each range, and takes from it the distinct
suffixes, which are the continuation counts of the order below, and so on.  Of each order
the model keeps keys and counts in a file a range; discounts follow from counts of
counts, which are the only numbers the driver sees.

Scoring lists a block's distinct n-grams of each order once.  A range's lists of all blocks meet
its file in one task, which reads that file and answers every list with small integers: the count
of each n-gram, and of each context its total and how many n-grams of it have counts 1, 2 and any;
all are 0 where unseen.  The answers go back to the block as one file, and discounting and
interpolation are done there.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import arrow_columns, map_arrow
from clinloom.llm.token_frames import open_store
from clinloom.session import checkpoint_dir

ORDER, BITS = 3, 21
WORD = (1 << BITS) - 1
UNSEEN = 0.5 ** BITS
HELD_KEYS = 2_000_000  # n-grams that a task holds before it adds them up
HELD = "keys binary, counts binary, n1 long, n2 long, n3 long, n4 long, grams long, total long"


def low(keys: np.ndarray, words: int) -> np.ndarray:
    """The last ``words`` words of each key."""
    return keys & ((1 << BITS * words) - 1)


# ---- packed arrays ---------------------------------------------------------------------

def pack(values: np.ndarray, differences: bool = False) -> bytes:
    import zstandard

    v = np.ascontiguousarray(np.diff(values, prepend=values.dtype.type(0)) if differences else values)
    return zstandard.compress(np.ascontiguousarray(v.view(np.uint8).reshape(len(v), -1).T).tobytes(), 1) if len(v) else b""


def unpack(data: bytes, kind: type, differences: bool = False) -> np.ndarray:
    import zstandard

    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    v = np.ascontiguousarray(raw.T).view(kind).ravel()
    return np.cumsum(v) if differences else v


def firsts(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted.  ``np.unique`` of integers may gather them in a hash table, which
    takes many times the time and memory of a sort."""
    ordered = np.sort(values)
    return ordered[firsts(ordered)]


def range_of(order: int, keys: np.ndarray, ranges: int) -> np.ndarray:
    """By the context; words, which have none, by themselves."""
    h = (keys >> BITS if order > 1 else keys).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(ranges)).astype(np.int64)


def dealt(order: int, keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys in the order of their ranges, and where each range begins in them."""
    r = range_of(order, keys, ranges)
    by = np.argsort(r.astype(np.uint16) if ranges <= 1 << 16 else r, kind="stable")  # short integers are sorted by radix
    return by, np.concatenate([[0], np.cumsum(np.bincount(r, minlength=ranges))])


def parts(order: int, keys: np.ndarray, counts: np.ndarray, ranges: int) -> pa.RecordBatch:
    """A row a range: its keys and counts, packed."""
    by, begin = dealt(order, keys, ranges)
    some = np.flatnonzero(begin[1:] > begin[:-1])
    cut = [by[begin[r]:begin[r + 1]] for r in some]
    return pa.record_batch([pa.array(some, pa.int32()), pa.array([pack(keys[c], True) for c in cut], pa.binary()),
                            pa.array([pack(counts[c]) for c in cut], pa.binary())], names=["range", "keys", "counts"])


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(keys)
    by = np.argsort(every, kind="stable")
    every, n = every[by], np.concatenate(counts)[by]
    first = firsts(every)
    return every[first], np.add.reduceat(n, first) if len(first) else n


def merged(rows: DataFrame, order: int) -> DataFrame:
    """A row a range: the sums of its parts, and how many n-grams have counts 1 to 4."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, counts = None, [], []

        def done() -> pa.RecordBatch:
            k, c = added(keys, counts)
            n = [int((c == i).sum()) for i in range(1, 5)] + [len(c)]
            return pa.record_batch([pa.array([at], pa.int32()), pa.array([pack(k, True)], pa.binary()), pa.array([pack(c)], pa.binary()),
                                    *(pa.array([x], pa.int64()) for x in (*n, int(c.sum())))], names=["range", "keys", "counts", "n1", "n2", "n3", "n4", "grams", "total"])

        for b in batches:
            for r, k, c in zip(*(x.to_pylist() for x in arrow_columns(b, "range", "keys", "counts")), strict=True):
                if r != at and at is not None:
                    yield done()
                    keys, counts = [], []
                at = r
                keys.append(unpack(k, np.int64, True))
                counts.append(unpack(c, np.int64))
                if len(keys) > 16:  # a range's parts are as many as there were tasks
                    k, c = added(keys, counts)
                    keys, counts = [k], [c]
        if at is not None:
            yield done()

    return map_arrow(rows.repartition("range").sortWithinPartitions("range"), run,
                     f"range int, {HELD}")


def counted(texts: DataFrame, ranges: int, word_keys) -> DataFrame:
    """Parts of the 3-grams of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for b in batches:
            raw = arrow_columns(b, "text")[0].cast(pa.binary()).to_pylist()
            for lo in range(0, len(raw), 200):
                k, c = np.unique(word_keys(raw[lo:lo + 200])[0], return_counts=True)
                keys.append(k)
                counts.append(c.astype(np.int64))
                size += len(k)
                if size > HELD_KEYS:
                    k, c = added(keys, counts)
                    keys, counts, size = [k], [c], len(k)
                    if size > HELD_KEYS // 2:
                        yield parts(ORDER, k, c, ranges)
                        keys, counts, size = [], [], 0
        if keys:
            yield parts(ORDER, *added(keys, counts), ranges)

    return map_arrow(texts, run, "range int, keys binary, counts binary")


def continued(rows: DataFrame, order: int, ranges: int) -> DataFrame:
    """Parts of the continuation counts of ``order`` from the distinct n-grams of the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for b in batches:
            for k in arrow_columns(b, "keys")[0].to_pylist():
                k, c = np.unique(low(unpack(k, np.int64, True), order), return_counts=True)
                keys.append(k)
                counts.append(c.astype(np.int64))
                size += len(k)
                if size > HELD_KEYS:
                    k, c = added(keys, counts)
                    keys, counts, size = [k], [c], len(k)
                    if size > HELD_KEYS // 2:
                        yield parts(order, k, c, ranges)
                        keys, counts, size = [], [], 0
        if keys:
            yield parts(order, *added(keys, counts), ranges)

    return map_arrow(rows.select("keys"), run, "range int, keys binary, counts binary")


# ---- the model ---------------------------------------------------------------------------

def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and 3 or more, from the numbers of n-grams of counts 1 to 4."""
    n = [0.0, *map(float, n)]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    return tuple(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) if n[i] else 0.5 * i for i in (1, 2, 3))


@dataclass(frozen=True)
class WordModel:
    """``folder``: per order and range a file of keys and counts.  ``first``: total and weight
    of the order without context."""

    folder: str
    ranges: int
    cuts: dict[int, tuple[float, float, float]]
    first: tuple[float, float]

    def load(self, order: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, their counts, contexts, and the contexts' sums (4 rows: total, n-grams of count
        1, of count 2, all); words have no contexts."""
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        store, root = open_store(f"{self.folder}/order={order}/range={part}")
        none = np.zeros(0, np.int64)
        if store.get_file_info(root).type == fs.FileType.NotFound:
            return none, none, none, none.reshape(4, 0)
        rows = pq.read_table(root, filesystem=store, columns=["keys", "counts"], partitioning=None)
        keys, c = unpack(rows["keys"][0].as_py(), np.int64, True), unpack(rows["counts"][0].as_py(), np.int64)
        if order == 1:
            return keys, c, none, none.reshape(4, 0)
        context = keys >> BITS
        begin = firsts(context)
        return keys, c, context[begin], np.stack([np.add.reduceat(x, begin) for x in (c, (c == 1).astype(np.int64), (c == 2).astype(np.int64), np.ones_like(c))])

    def left(self, order: int, c: np.ndarray) -> np.ndarray:
        """Counts without their discounts."""
        return c - np.array([0.0, *self.cuts[order]])[np.minimum(c, 3)]

    def taken(self, order: int, sums: np.ndarray) -> np.ndarray:
        """The weight of the order below in contexts of these sums (1 where unseen)."""
        total, one, two, grams = sums
        d = self.cuts[order]
        return np.where(total > 0, (d[0] * one + d[1] * two + d[2] * (grams - one - two)) / np.maximum(total, 1), 1.0)


def fit(texts: DataFrame, word_keys, ranges: int | None = None) -> WordModel:
    """The model of the texts (column ``text``).  A range should fit a task's memory a few
    times over; by default there are four for each shuffle partition."""
    spark = texts.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/words-{uuid.uuid4().hex}"
    cuts, total = {}, 0
    source = counted(texts, ranges, word_keys)
    for order in range(ORDER, 0, -1):
        merged(source, order).write.partitionBy("range").parquet(f"{folder}/order={order}")
        rows = spark.read.schema(f"{HELD}, range int").parquet(f"{folder}/order={order}")
        n = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n1", "n2", "n3", "n4", "grams", "total"))).first()
        cuts[order], total = discounts([n.n1, n.n2, n.n3, n.n4]), n.total
        source = continued(rows, order - 1, ranges) if order > 1 else None
    taken = cuts[1][0] * n.n1 + cuts[1][1] * n.n2 + cuts[1][2] * (n.grams - n.n1 - n.n2)
    return WordModel(folder, ranges, cuts, (float(total), taken / total) if total else (1.0, 1.0))


# ---- scoring -------------------------------------------------------------------------------

def lists(triples: np.ndarray) -> dict[int, np.ndarray]:
    """The distinct n-grams that the scores of distinct 3-grams need, by order."""
    return {3: triples, 2: distinct(low(triples, 2)), 1: distinct(low(triples, 1))}


def asked(name: int, part: int, triples: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """The lists of a part of a block, a row an order and range."""
    for order, keys in lists(triples).items():
        by, begin = dealt(order, keys, ranges)
        some = np.flatnonzero(begin[1:] > begin[:-1])
        yield pa.record_batch([pa.array(np.full(len(some), order), pa.int32()), pa.array(some, pa.int32()), pa.array(np.full(len(some), name), pa.int64()),
                               pa.array(np.full(len(some), part), pa.int32()),
                               pa.array([pack(keys[by[begin[r]:begin[r + 1]]], True) for r in some], pa.binary())], names=["ord", "range", "block", "part", "keys"])


def answers(rows: DataFrame, model: WordModel) -> DataFrame:
    """(block, part, ord, range, counts, sums) for each list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for b in (b.slice(lo, 64) for b in batches for lo in range(0, b.num_rows, 64)):  # few answers are held at once
            counts, sums = [], []
            for o, r, k in zip(*(x.to_pylist() for x in arrow_columns(b, "ord", "range", "keys")), strict=True):
                if at != (o, r):
                    at, held = (o, r), None  # the range before goes first
                    held = model.load(o, r)
                wanted = unpack(k, np.int64, True)
                counts.append(pack(looked_up(wanted, held[0], held[1])))
                context = wanted >> BITS if o > 1 else wanted[:0]
                sums.append(pack(looked_up(context[firsts(context)], held[2], held[3]).ravel()))
            yield pa.record_batch([*arrow_columns(b, "block", "part", "ord", "range"), pa.array(counts, pa.binary()), pa.array(sums, pa.binary())],
                                  names=["block", "part", "ord", "range", "counts", "sums"])

    dealt_rows = rows.repartition("ord", "range").sortWithinPartitions("ord", "range")
    return map_arrow(dealt_rows, run, "block long, part int, ord int, range int, counts binary, sums binary")


def looked_up(wanted: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values of the wanted keys, 0 for those that are not there."""
    if not len(keys):
        return np.zeros((*values.shape[:-1], len(wanted)), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[..., at] * (keys[at] == wanted)


def log_probs(triples: np.ndarray, found: pa.Table, model: WordModel) -> np.ndarray:
    """log p of distinct 3-grams from the answers to their lists, a range at a time."""
    got = {(o, r): (c, s) for o, r, c, s in zip(*(found[c].to_pylist() for c in ("ord", "range", "counts", "sums")), strict=True)}
    known, p = lists(triples), None
    for order in (1, 2, 3):
        keys = known[order]
        if order > 1:  # of each n-gram's suffix; the suffixes are the list of the order below
            below = p[np.unique(low(keys, order - 1), return_inverse=True)[1]]
        p = np.empty(len(keys))
        by, begin = dealt(order, keys, model.ranges)
        for r in np.flatnonzero(begin[1:] > begin[:-1]).tolist():
            own = by[begin[r]:begin[r + 1]]
            c, s = got[order, r]
            left = model.left(order, unpack(c, np.int64))
            if order == 1:
                p[own] = left / model.first[0] + model.first[1] * UNSEEN
                continue
            context = keys[own] >> BITS
            of = unpack(s, np.int64).reshape(4, -1)[:, np.cumsum(np.append(False, context[1:] != context[:-1]))]
            p[own] = left / np.maximum(of[0], 1) + model.taken(order, of) * below[own]
    return np.log(p)
