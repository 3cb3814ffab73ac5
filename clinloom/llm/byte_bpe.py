"""Byte-level BPE encoding and decoding with DuckDB queries inside each partition.

The rank file gives every token a rank that is also its id.  The merge table holds
each pair of tokens whose concatenation is a token.  A recursive query keeps one row
per (word, token position), which also names the token behind it; each step joins these
pairs with the merge table and contracts, in every word that still has a mergeable pair, the leftmost pair of
minimum rank, until no word changes.  Decoding joins ids with the vocabulary and
aggregates the bytes in position order.  The database lives in the worker's memory
and works on the distinct words of a batch only; nothing is shuffled.

Defined results: a null text counts as empty and has no ids; repeated rows are encoded
each on its own; a null doc_id stays null; other columns are ignored; an empty table
gives an empty one.  Texts have no length limit; a word of more than LONG_WORD bytes is
contracted by the same rule through a heap over the same merge table, because the
recursion writes a word's rows anew at each step.
"""
from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import SegmentCache, arrow_columns, id_text, map_arrow, slices, table, worker_cache

LONG_WORD = 256
RANKS = "byte_bpe_50k.tiktoken"

_ENCODE = """
WITH RECURSIVE step(it, w, pos, tok, npos, nxt) AS (
    SELECT 0, w, pos, tok, npos, nxt FROM pieces
    UNION ALL (
        WITH best AS (
            SELECT w, min(merged * 4294967296 + pos * 65536 + npos) AS k
            FROM step JOIN merges ON tok = l AND nxt = r GROUP BY w),
        hit AS (
            SELECT s.w, (k >> 32)::INT AS m, (k >> 16) & 65535 AS p, s.pos AS q, s.npos AS qn, s.nxt AS qt
            FROM best b JOIN step s ON s.w = b.w AND s.pos = (k & 65535))
        SELECT s.it + 1, s.w, s.pos, CASE WHEN s.pos = p THEN m ELSE s.tok END,
               CASE WHEN s.pos = p THEN qn ELSE s.npos END,
               CASE WHEN s.pos = p THEN qt WHEN s.npos = p THEN m ELSE s.nxt END
        FROM step s JOIN hit USING (w) WHERE s.pos <> q))
SELECT list(tok ORDER BY pos) AS ids
FROM step JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) USING (w, it)
GROUP BY w ORDER BY w
"""

_DECODE = """
SELECT string_agg(bytes, '' ORDER BY pos) AS decoded FROM ids JOIN vocab USING (tok) GROUP BY w ORDER BY w
"""


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


class Codec:
    """One worker's in-memory database with the merge table and the vocabulary."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        self.words = regex.compile(pattern).findall
        rows = [(l, r, m) for t, m in self.ranks.items() for i in range(1, len(t))
                if (l := self.ranks.get(t[:i])) is not None and (r := self.ranks.get(t[i:])) is not None]
        l, r, m = np.array(rows, np.int32).reshape(-1, 3).T
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self._load("merges", pa.table({"l": l, "r": r, "merged": m.astype(np.int64)}))
        self._load("vocab", pa.table({"tok": np.array(list(self.ranks.values()), np.int32),
                                      "bytes": [t.decode("latin-1") for t in self.ranks]}))  # a character for a byte
        self.memo = SegmentCache(self.encode_units, most_segments=120_000, most_units=200_000)

    @cached_property
    def pair(self) -> dict[tuple[int, int], int]:
        return {(a, b): m for m in self.names for i in range(1, len(self.names[m]))
                if (a := self.ranks.get(self.names[m][:i])) is not None and (b := self.ranks.get(self.names[m][i:])) is not None}

    @cached_property
    def names(self) -> dict[int, bytes]:
        return {i: t for t, i in self.ranks.items()}

    def _load(self, name: str, rows: pa.Table) -> None:
        self.db.register("loading", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM loading")
        self.db.unregister("loading")

    def _query(self, name: str, rows: pa.Table, sql: str) -> pa.ChunkedArray:
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table().column(0)
        finally:
            self.db.unregister(name)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each non-empty word as little-endian 32-bit integers."""
        out = [b""] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) <= LONG_WORD:
                short.append(i)
            else:
                out[i] = np.array(self._contract_long(w), "<i4").tobytes()
        for lo in range(0, len(short), 10_000):
            part = short[lo:lo + 10_000]
            sizes = np.array([len(words[i]) for i in part])
            ends = np.cumsum(sizes)
            toks = self.byte_id[np.frombuffer(b"".join([words[i] for i in part]), np.uint8)]
            pos = np.arange(len(toks), dtype=np.int64) - np.repeat(ends - sizes, sizes)
            npos, nxt = pos + 1, np.append(toks[1:], -1).astype(np.int32)
            npos[ends - 1] = nxt[ends - 1] = -1
            rows = pa.table({"w": np.repeat(np.arange(len(part), dtype=np.int32), sizes), "pos": pos, "tok": toks, "npos": npos, "nxt": nxt})
            ids = self._query("pieces", rows, _ENCODE).combine_chunks()
            raw, at = ids.values.to_numpy().astype("<i4").tobytes(), (4 * ids.offsets.to_numpy().astype(np.int64)).tolist()
            for k, i in enumerate(part):
                out[i] = raw[at[k]:at[k + 1]]
        return out

    def _contract_long(self, word: bytes) -> list[int]:
        tok = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(tok)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(m, i) for i in range(n - 1) if (m := self.pair.get((tok[i], tok[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = right[i] if tok[i] >= 0 else n
            if j >= n or self.pair.get((tok[i], tok[j])) != m:
                continue  # a pair that an earlier contraction has changed
            tok[i], tok[j], right[i] = m, -1, right[j]
            if right[i] < n:
                left[right[i]] = i
            for a in (left[i], i):
                if a >= 0 and right[a] < n and (k := self.pair.get((tok[a], tok[right[a]]))) is not None:
                    heapq.heappush(heap, (k, a))
        return [t for t in tok if t >= 0]

    def _split(self, unit: str) -> list[str]:
        return [unit] if unit[1:].isalpha() and (unit[0] == " " or unit[0].isalpha()) or len(unit) == 1 else self.words(unit)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit (usually one word)."""
        parts = [self._split(u) for u in units]
        distinct = list({w for p in parts for w in p})
        ids = dict(zip(distinct, self.encode_words([w.encode() for w in distinct]), strict=True))
        return [ids[p[0]] if len(p) == 1 else b"".join([ids[w] for w in p]) for p in parts]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b, "<i4") for b in self.memo(texts)]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        sizes = np.array([len(i) for i in ids], np.int64)
        out = [b""] * len(ids)
        full = np.flatnonzero(sizes)
        if len(full):
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            rows = pa.table({"w": np.repeat(np.arange(len(ids), dtype=np.int32), sizes),
                             "pos": (np.arange(len(first)) - first).astype(np.int32),
                             "tok": np.concatenate([ids[i] for i in full])})
            for i, b in zip(full.tolist(), self._query("ids", rows, _DECODE).to_pylist(), strict=True):
                out[i] = b.encode("latin-1")
        return out


@worker_cache
def codec(ranks_path: str | None, pattern: str | None) -> Codec:
    import public_tokenizers

    return Codec(ranks_path or default_ranks(), pattern or public_tokenizers.PATTERN)


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, decoded: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, in order; with ``decoded`` also the bytes
    decoded from these ids, by the same worker."""
    docs = id_text(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for b in batches:
            doc, text = arrow_columns(b, "doc_id", "text")
            for lo, hi in slices(text.to_pylist(), 2_000_000):
                ids = c.encode(text.slice(lo, hi - lo).to_pylist())
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                cols = [doc.slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))]
                if decoded:
                    cols.append(pa.array(decoded_texts(c, ids), pa.binary()))
                yield pa.record_batch(cols, names=["doc_id", "ids", *["decoded"] * decoded])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs, run, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded)


def decoded_texts(c: Codec, ids: list[np.ndarray], most: int = 200_000) -> list[bytes]:
    """Decode in runs of about ``most`` ids; a longer text in ranges of positions."""
    ranges = [(i, x[p:p + most]) for i, x in enumerate(ids) for p in range(0, max(len(x), 1), most)]
    out = [[] for _ in ids]
    lo = size = 0
    for hi, (_, x) in enumerate([*ranges, (0, ids[:0])]):
        if hi > lo and (size + len(x) > most or hi == len(ranges)):
            for (i, _), b in zip(ranges[lo:hi], c.decode([x for _, x in ranges[lo:hi]]), strict=True):
                out[i].append(b)
            lo, size = hi, 0
        size += len(x)
    return [b"".join(b) for b in out]


def decode(rows: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``rows`` (doc_id, ids) with the column ``decoded``: the bytes of the ids in
    order (null ids count as none).  An id outside the vocabulary is an error."""
    rows = rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for b in batches:
            ids = arrow_columns(b, "ids")[0]
            ends, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
            if len(values) and not (0 <= values.min() and values.max() < len(c.ranks)):
                raise ValueError("an id is outside the vocabulary")
            out = decoded_texts(c, [values[ends[i]:ends[i + 1]] for i in range(b.num_rows)])
            yield pa.record_batch([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "decoded"])

    return map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"), decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
