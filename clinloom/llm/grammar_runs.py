"""Runs of periodically repeated words, found on a grammar of the text.

*Grammar.*  Re-Pair replaces repeated pairs of neighbouring symbols, frequent ones first, by
new symbols until no pair of a document occurs twice.  Here a pass replaces many pairs at once, of
many documents: an occurrence goes if its pair is more frequent than those that overlap it
(ties by the pair's ids), so the most frequent pair of a document always goes.  Symbols belong to one
document, words are the first ones.  A pair that occurs once stays so, as its symbols only grow;
its boundary is settled, and later passes look at what is left.

*Runs.*  A run lies across the boundary inside the smallest node that holds it: a rule
X -> Y Z, or the final sequence of its document.  So runs across the boundary between Y and Z
are sought once for each rule, in its expansion, and then moved to all places where the rule
was applied; boundaries of the final sequence occur once.  A run of period q and at least 4 q
words has 2 q of them (and 3 words) on one side of the boundary.  With 2**j <= q < 2**(j + 1) the 2**j
words there recur q words on, so only such recurrences are candidates; common extensions to
both sides give the run.  Equal 2**j words have equal names (from pairs of names, level by level);
names that occur once end the search early.  Pieces that a node's end cuts off lie within the whole run, found at a
larger node, with the same period: of nested intervals of a period the largest stays.  Of periods
with the same interval the smallest is the run's.

All steps work on arrays of many documents' symbols at once; a document's work stays in its
task, and nothing is shuffled.

Defined results: a null or empty text has no words and no runs; repeated rows give equal
results; a null doc_id stays null and is never altered by ``periodic_tail``; other columns are ignored;
an empty table gives an empty one.  Texts may be of any length: documents are
worked on in groups of about ``GROUP`` words, a longer one alone.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import arrow_columns, id_text, map_arrow, table

LEAST, TIMES = 6, 4  # words and periods that a run has at least
GROUP = 400_000


@dataclass
class Words:
    """Documents' words as numbers, one document behind the other: ``ids`` (equal words of a
    document have equal ids, different documents none in common) and ``ends``."""

    ids: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, docs: list[list[bytes]]) -> "Words":
        ids, base = [], 0
        for words in docs:
            number = {w: i for i, w in enumerate(dict.fromkeys(words), base)}
            ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            base += len(number)
        sizes = np.array([len(w) for w in docs], np.int64)
        return cls(np.concatenate(ids) if ids else np.zeros(0, np.int64), np.cumsum(sizes))

    def bounds(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The document that holds each position, as [start, end)."""
        d = np.searchsorted(self.ends, at, side="right")
        return np.where(d > 0, self.ends[d - 1], 0), self.ends[d]


@dataclass
class Node:
    """Boundaries to be searched, each between two words inside [start, end), and ``moves``:
    (boundary, distance) of all other places where the same expansion was derived."""

    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    moves: tuple[np.ndarray, np.ndarray]


def occurrences(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of equal keys (by order) and how often each occurs."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    name = np.empty(len(key), np.int64)
    name[order] = np.cumsum(new) - 1
    return name, np.bincount(name)


def repair(words: Words) -> list[Node]:
    """Re-Pair of all documents.  Returns the rules' nodes, pass by pass, and at last one with
    the boundaries of the final sequences."""
    n = len(words.ids)
    symbol, start, size = words.ids.copy(), np.arange(n), np.ones(n, np.int64)
    joined = np.ones(n, bool)  # whether a symbol's pair with the next one may still be replaced
    joined[words.ends[words.ends > 0] - 1] = False
    symbols = int(symbol.max(initial=-1)) + 1
    nodes, settled = [], [np.zeros(0, np.int64)]
    while True:
        at = np.flatnonzero(joined)
        left, right = symbol[at], symbol[at + 1]
        name, count = occurrences(left * symbols + right)
        # of a stretch of equal symbols, every other pair counts
        equal = left == right
        usable = np.ones(len(at), bool)
        if equal.any():
            first = equal.copy()
            first[1:] &= ~((at[1:] == at[:-1] + 1) & equal[:-1])
            begin = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            usable = ~equal | ((np.arange(len(at)) - begin) % 2 == 0)
            count = np.bincount(name[usable], minlength=len(count))
        times = count[name]
        single = times < 2
        joined[at[single]] = False
        settled.append(start[at[single] + 1])
        at, name, times, usable = at[~single], name[~single], times[~single], usable[~single]
        if not len(at):
            break
        # an occurrence is replaced if no overlapping one has precedence
        rank = np.full(len(symbol) + 1, -1, np.int64)
        best = np.lexsort((name, times))
        order = np.empty(len(at), np.int64)
        new = np.ones(len(at), bool)
        new[1:] = name[best][1:] != name[best][:-1]
        order[best] = np.cumsum(new)  # equal pairs, equal precedence
        rank[at] = np.where(usable, order, -1)
        here = rank[at]
        chosen = usable & (here >= np.where(at > 0, rank[at - 1], -1)) & (here >= rank[at + 1])
        # equal precedence of neighbours: only pairs of one symbol overlap themselves, and those alternate
        at, name = at[chosen], name[chosen]
        _, use = np.unique(name, return_inverse=True)
        total = size[at] + size[at + 1]
        first = np.unique(use, return_index=True)[1]
        big = total[first] >= LEAST
        nodes.append(node_of(start[at], size[at], total, use, first, big))
        # rewrite: the pair's first symbol becomes the rule's
        symbol[at], size[at], joined[at] = symbols + use, total, joined[at + 1]
        symbols += len(first)
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        # symbols whose boundaries are settled on both sides take no part any more
        part = joined.copy()
        kept = np.flatnonzero(stay)
        part_kept = part[kept]
        part_kept[1:] |= joined[kept][:-1]
        kept = kept[part_kept]
        symbol, start, size, joined = symbol[kept], start[kept], size[kept], joined[kept]
    cut = np.concatenate(settled)
    lo, hi = words.bounds(cut)
    nodes.append(Node(cut, lo, hi, (np.zeros(0, np.int64), np.zeros(0, np.int64))))
    return nodes


def node_of(start: np.ndarray, half: np.ndarray, total: np.ndarray, use: np.ndarray, first: np.ndarray, big: np.ndarray) -> Node:
    """The node of a pass: its rules that can hold a run, each at its first place, and the moves."""
    number = np.cumsum(big) - 1
    begin = start[first]
    other = big[use] & (start != begin[use])
    return Node((start + half)[first][big], begin[big], (start + total)[first][big],
                (number[use[other]], (start - begin[use])[other]))


def joined_nodes(nodes: list[Node]) -> Node:
    """The nodes as one, so that all boundaries are searched together."""
    first = np.cumsum([0, *(len(n.at) for n in nodes)])
    moves = tuple(np.concatenate(m) for m in zip(*((n.moves[0] + f, n.moves[1]) for n, f in zip(nodes, first, strict=False)), strict=True))
    return Node(*(np.concatenate([getattr(n, c) for n in nodes]) for c in ("at", "start", "end")), moves)


class Names:
    """Names of all stretches of 2**j words, level by level: equal stretches of a document have
    equal names; -1 where a stretch occurs once (or leaves its document)."""

    def __init__(self, words: Words):
        n = len(words.ids)
        _, end = words.bounds(np.arange(n)) if n else (None, np.zeros(0, np.int64))
        self.levels: list[np.ndarray] = []
        self.places: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        names, count = occurrences(words.ids)
        level = np.where(count[names] > 1, names, -1) if n else names
        size = 1
        while (level >= 0).any():
            self.levels.append(level)
            here = np.flatnonzero(level >= 0)
            here = here[(here + 2 * size <= end[here])]
            here = here[level[here + size] >= 0]
            names, count = occurrences(level[here] * n + level[here + size])
            up = np.full(n, -1, np.int64)
            up[here] = np.where(count[names] > 1, names, -1)
            level, size = up, 2 * size
        self.n = n

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on are equal, one by one (a < b)."""
        out = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            while True:  # more than once only on the top level
                x, y = a + out, b + out
                ok = (y < self.n)
                nx, ny = self.levels[j][np.where(ok, x, 0)], self.levels[j][np.where(ok, y, 0)]
                same = ok & (nx >= 0) & (nx == ny)
                out += same * (1 << j)
                if j < len(self.levels) - 1 or not same.any():
                    break
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b are equal, backwards (a < b)."""
        out = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            while True:
                x, y = a - out - (1 << j), b - out - (1 << j)
                ok = x >= 0
                nx, ny = self.levels[j][np.where(ok, x, 0)], self.levels[j][np.where(ok, y, 0)]
                same = ok & (nx >= 0) & (nx == ny)
                out += same * (1 << j)
                if j < len(self.levels) - 1 or not same.any():
                    break
        return out

    def recurrences(self, level: int, at: np.ndarray, least: int, most: int, later: bool) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``at``, distance) of all recurrences of the stretch of a level at a
        distance of ``least`` to ``most``, after or before it."""
        names = self.levels[level]
        if level not in self.places:
            known = np.flatnonzero(names >= 0)
            order = known[np.argsort(names[known], kind="stable")]
            self.places[level] = order, names[order] * self.n + order  # sorted: by name, then position
        order, key = self.places[level]
        asked = np.flatnonzero(names[at] >= 0)
        base = names[at[asked]] * self.n
        low, high = (at[asked] + least, at[asked] + most) if later else (at[asked] - most, at[asked] - least)
        i, j = np.searchsorted(key, base + np.maximum(low, 0)), np.searchsorted(key, base + np.minimum(high, self.n - 1), side="right")
        j = np.where(high < 0, i, np.maximum(i, j))
        many = j - i
        where = np.repeat(i, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        who = np.repeat(asked, many)
        return who, np.abs(order[where] - at[who])


def crossing(node: Node, names: Names) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(boundary, start, end, period) of the runs across each boundary, inside its node."""
    found = [tuple(np.zeros(0, np.int64) for _ in range(4))]
    for j in range(len(names.levels)):
        words = max(2, 1 << j)  # these recur; a period of one word has three on one side
        level = words.bit_length() - 1
        if level >= len(names.levels):
            break
        for later in (True, False):
            at = node.at if later else node.at - words
            who = np.flatnonzero((at >= node.start) & (at + words <= node.end))
            part, q = names.recurrences(level, at[who], 1 << j, (2 << j) - 1, later)
            who = who[part]
            room = TIMES * q <= node.end[who] - node.start[who]
            who, q = who[room], q[room]
            x = at[who] if later else at[who] - q  # words at x and at x + q begin equal stretches
            x, who, q = (v[(x >= node.start[who]) & (x + q + words <= node.end[who])] for v in (x, who, q))
            ahead, back = names.forward(x, x + q), names.backward(x, x + q)
            begin = np.maximum(x - back, node.start[who])
            end = np.minimum(x + q + ahead, node.end[who])
            own = (end - begin >= np.maximum(LEAST, TIMES * q)) & (begin < node.at[who]) & (end > node.at[who])
            found.append((who[own], begin[own], end[own], q[own]))
    who, begin, end, q = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((q, end, begin, who))  # of the same interval the smallest period
    who, begin, end, q = who[order], begin[order], end[order], q[order]
    keep = np.ones(len(who), bool)
    keep[1:] = (who[1:] != who[:-1]) | (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return who[keep], begin[keep], end[keep], q[keep]


def runs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of all documents, by start, then period."""
    if not len(words.ids):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    names, node = Names(words), joined_nodes(repair(words))
    who, begin, end, q = crossing(node, names)
    # each run goes to all places of its rule: join of moves and runs on the boundary
    boundary, by = node.moves
    first, last = np.searchsorted(who, boundary), np.searchsorted(who, boundary, side="right")
    many = last - first
    pick = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    by = np.repeat(by, many)
    begin, end, q = np.append(begin, begin[pick] + by), np.append(end, end[pick] + by), np.append(q, q[pick])
    order = np.lexsort((-end, begin, q))
    begin, end, q = begin[order], end[order], q[order]
    # within a period, an interval that ends no later than one before it is a piece of that
    reach = np.maximum.accumulate(end + q * (len(words.ids) + 1))
    whole = np.ones(len(q), bool)
    whole[1:] = (end + q * (len(words.ids) + 1))[1:] > reach[:-1]
    begin, end, q = begin[whole], end[whole], q[whole]
    order = np.lexsort((q, begin))
    return begin[order], end[order], q[order]


def periodic_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by a hash of the id, with a tail that repeats its first words."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]


def groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, s in enumerate(sizes):
        if i > lo and size + s > most:
            yield lo, i
            lo, size = i, 0
        size += s
    if lo < len(sizes):
        yield lo, len(sizes)


def find_runs(docs: DataFrame, alter: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed (the
    words that no run holds after its first period, joined by spaces) of every document.
    ``alter(doc_id, words)`` may change a document's words first."""
    docs = id_text(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def found(ids: pa.Array, docs_: list[list[bytes]]) -> pa.RecordBatch:
        words = Words.of(docs_)
        begin, end, q = runs(words)
        first = np.concatenate([[0], words.ends])
        of = np.searchsorted(words.ends, begin, side="right")
        drop = np.zeros(len(words.ids) + 1, np.int64)
        np.add.at(drop, begin + q, 1)
        np.add.at(drop, end, -1)
        gone = np.cumsum(drop)[:-1] > 0
        some = set(of.tolist())
        collapsed = []
        for i, w in enumerate(docs_):
            if i in some:
                w = [x for x, g in zip(w, gone[first[i]:first[i + 1]].tolist(), strict=True) if not g]
            collapsed.append(b" ".join(w))
        ends = np.searchsorted(of, np.arange(len(docs_) + 1))
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(begin - first[of]), pa.array(end - begin), pa.array(q)], fields=list(run)))
        return pa.record_batch([ids, pa.array([len(w) for w in docs_], pa.int64()), listed, pa.array(collapsed, pa.binary()).cast(pa.string())],
                               names=["doc_id", "n_words", "runs", "collapsed"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, text = arrow_columns(b, "doc_id", "text")
            sizes = pa.compute.binary_length(text).to_pylist()
            for lo, hi in groups([s // 6 for s in sizes], GROUP):
                part = ids.slice(lo, hi - lo)
                cut = [t.encode().split() for t in text.slice(lo, hi - lo).to_pylist()]
                if alter:
                    cut = [alter(i, w) for i, w in zip(part.to_pylist(), cut, strict=True)]
                yield found(part, cut)

    return map_arrow(docs, work, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def op11_grammar_runs(spark, sf_dir: str) -> DataFrame:
    docs = find_runs(table(spark, sf_dir, "documents"), periodic_tail)

    def better(a, b):
        """Of two runs the one of greater exponent (the earlier, which a is, on a tie)."""
        return F.when(b["length"].cast("decimal(19,0)") * a["period"].cast("decimal(19,0)")
                      > a["length"].cast("decimal(19,0)") * b["period"].cast("decimal(19,0)"), b).otherwise(a)

    docs = docs.withColumn("best", F.when(F.size("runs") > 0, F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)), better)))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return docs.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
