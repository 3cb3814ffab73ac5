"""Small helpers shared by the training-data operators."""
from __future__ import annotations

import ctypes
import gc
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain, compress, pairwise
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Unicode White_Space, the class that `\s` means in the tokenizer patterns.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Texts with other white space than single spaces and line feeds.
_MIXED = "[ \n]{2}|[" + "".join(c for c in WHITE if c not in " \n") + "]"
_SEGMENT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers can import this library: from its installation on
    the executors, or else from the folder that the driver imported it from."""
    env = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in (paths := [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]):
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    owner = run.__module__

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_caches_of(owner)
        try:
            yield from run(batches)
        finally:
            give_back_memory()

    return df.mapInArrow(task, schema)


_CACHES: dict[str, list[Callable]] = {}


def worker_cache(make: Callable) -> Callable:
    """What ``make`` returns is kept by a worker as long as it runs the same operator."""
    made = lru_cache(maxsize=2)(make)
    _CACHES.setdefault(make.__module__, []).append(made.cache_clear)
    return made


def keep_caches_of(owner: str) -> None:
    for module, clear in _CACHES.items():
        if module != owner:
            for c in clear:
                c()


def give_back_memory() -> None:
    """Freed memory of a finished task goes back to the system; idle workers stay small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def each_text(column: pa.Array, rows: int = 500) -> Iterator[str]:
    """The texts of a column, some hundred at a time as Python strings."""
    for lo in range(0, len(column), rows):
        yield from column.slice(lo, rows).to_pylist()


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator reads, a null text as the empty one; extra columns
    of the input never reach the operator, so their names cannot clash."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def segments(text: str) -> list[str]:
    """Cut before each run of white space.  No pre-token of the byte-level or
    word patterns goes from a visible character into white space, so each segment
    is encoded independently of its neighbours and ids concatenate."""
    return _SEGMENT.findall(text)


_MARKS = frozenset(".,;:!?|")


def units(segment: str) -> tuple[str, ...]:
    """The pre-tokens of the commonest segments: a word after a space or at a line's
    start, perhaps with one mark behind it.  Any other segment is one unit."""
    head = segment[0]
    if segment[1:].isalpha() and (head == " " or head.isalpha()):
        return (segment,)
    body, mark = (segment[:-1], segment[-1:]) if segment[-1] in _MARKS and len(segment) > 1 else (segment, "")
    if body[1:].isalpha() and (head == " " or head == "\n" or head.isalpha()) or len(body) == 1 and body.isalpha():
        parts = ("\n", body[1:]) if head == "\n" else (body,)
        return (*parts, mark) if mark else parts
    return (segment,)


class Memo:
    """Bounded memo of key -> value that a worker keeps between tasks.  It has two
    generations: when the young one is full the old one goes, so common keys stay."""

    def __init__(self, make: Callable[[list[str]], list], most: int):
        self.make, self.most = make, most
        self.young: dict = {}
        self.old: dict = {}

    def ensure(self, keys: Iterable[str]) -> dict:
        """A dict that holds at least these keys; the unknown ones are made in one call."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = set(keys).difference(young)
        known = missing.intersection(old) if old else ()
        young.update((k, old[k]) for k in known)
        new = list(missing.difference(known))
        if new:
            young.update(zip(new, self.make(new), strict=True))
        return young


class SegmentCache:
    """Encodes texts through memos of their segments and of the segments' units (without
    ``split``, of segments only); ``encode(units)`` gives the bytes of the ids of each.  An
    entry takes about 200 bytes, and there are twice as many as the bounds say at most.

    Texts are cut and their segments numbered by Arrow; the memos are asked once for each
    different segment of a call, and the bytes are laid out by these numbers."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], split: Callable[[str], Sequence[str]] | None = units,
                 most_segments: int = 250_000, most_units: int = 250_000):
        gc.set_threshold(100_000, 20, 100)  # strings and bytes by the million, hardly a cycle
        self.split = split
        self.units = Memo(encode, most_units)
        self.segments = Memo(self._join, most_segments // 8)
        self.spaced = Memo(lambda cut: self._join([s if s[:1] == "\n" else " " + s for s in cut]), most_segments)

    def _join(self, cut: list[str]) -> list[bytes]:
        if self.split is None:
            return self.units.make(cut)
        parts = [self.split(s) if s else () for s in cut]
        get = self.units.ensure(u for p in parts for u in p).__getitem__
        return [get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for p in parts]

    def _single_spaced(self, texts: pa.Array) -> list[bytes]:
        """Segments here are what stands between spaces, a line feed counting as one
        before itself; they are kept without their leading space."""
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        ends, numbered = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        first = cut.values.take(pa.array(ends[:-1])).to_pylist()  # no space before these
        words = numbered.dictionary.to_pylist()
        found = [*map(self.spaced.ensure(words).__getitem__, words), *map(self.segments.ensure(first).__getitem__, first)]
        at = numbered.indices.to_numpy().copy()
        at[ends[:-1]] = np.arange(len(words), len(found))
        laid = pa.array(found, pa.large_binary()).take(pa.array(at))
        _, offsets, data = laid.buffers()
        bounds = np.frombuffer(offsets, np.int64)[ends].tolist()
        raw = memoryview(data) if data else b""
        return [bytes(raw[a:z]) for a, z in pairwise(bounds)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        column = pa.array(texts, pa.string())
        mixed = pc.match_substring_regex(column, _MIXED)
        easy = iter(self._single_spaced(column.filter(pc.invert(mixed))))
        kind = mixed.to_pylist()
        cut = [segments(t) for t, m in zip(texts, kind, strict=True) if m]
        get = self.segments.ensure(chain.from_iterable(cut)).__getitem__
        hard = iter([b"".join(map(get, c)) for c in cut])
        return [next(hard if m else easy) for m in kind]


class JoinedEncoder:
    """Ids of many units by few calls of a tokenizer.  Units for which ``joins`` holds are
    encoded as one text, and its ids are cut where the tokens' lengths (in bytes) reach the
    units' ends: the normaliser must keep these units' lengths, and no pre-token may span
    two of them.  All others are encoded one by one."""

    def __init__(self, tokenizer, kind: str, gap: str, joins: Callable[[str], bool], end_of_word: str = ""):
        self.t, self.kind, self.gap, self.joins = tokenizer, kind, gap, joins
        names = map(tokenizer.id_to_token, range(tokenizer.get_vocab_size()))
        self.size = np.array([len(n.removesuffix(end_of_word)) for n in names])  # a character for a byte

    def _each(self, units: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.t.encode_batch_fast(units, add_special_tokens=False)]

    def _joined(self, units: list[str]) -> list[bytes]:
        ids = array(self.kind, self.t.encode_batch_fast([self.gap.join(units)], add_special_tokens=False)[0].ids)
        reached = np.cumsum(self.size[np.frombuffer(ids, self.kind)])
        ends = np.cumsum([len(u.encode()) for u in units])
        at = np.searchsorted(reached, ends) + 1
        if len(reached) < at[-1] or (reached[at - 1] != ends).any() or reached[-1] != ends[-1]:
            return self._each(units)
        raw = ids.tobytes()
        return [raw[a:z] for a, z in pairwise([0, *(ids.itemsize * at).tolist()])]

    def __call__(self, units: list[str], together: int = 20_000) -> list[bytes]:
        fits = [self.joins(u) for u in units]
        join, rest = [list(compress(units, f)) for f in (fits, map(not_, fits))]
        joined = iter([b for lo in range(0, len(join), together) for b in self._joined(join[lo:lo + together])])
        each = iter(self._each(rest))
        return [next(joined if f else each) for f in fits]


def slices(texts: list[str], most_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of at most ``most_chars`` characters (a longer text alone)."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > most_chars:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def arrow_columns(batch: pa.RecordBatch, *names: str) -> list:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]
