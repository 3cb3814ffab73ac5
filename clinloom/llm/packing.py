"""Sum-of-squares online packing of token sequences into fixed windows.

A document's ids, closed by ``end_id``, fill whole windows of their own as long as they
can; the rest, 1 to capacity - 1 ids, goes at once into a partly filled window or a new
one.  A level array counts the open windows by fill level, and the chosen level is the
one that makes the sum of the squared counts smallest (ties: the fullest window).  Each
partition packs its own rows with its own windows, so nothing is shuffled.

A sequence is padded to ``capacity`` unless its length is a power of two.  Windows still
open when a partition ends (or when more than ``most_open`` are open: the fullest half)
are laid end to end and cut into full windows, and the last of these into powers of two,
so they need no padding; that cut may split a piece.

Defined results: a null or empty text has the end id alone; repeated rows are packed each
on its own; a null doc_id stays null; other columns are ignored; an empty table gives an
empty one.  ``sequence_id`` is unique in the result; it depends on the partition of a row, so
the input should be files or a written table, as everywhere where tasks may run again.
"""
from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clinloom.llm.common import WHITE, JoinedEncoder, SegmentCache, arrow_columns, id_text, map_arrow, slices, table, worker_cache

VOCABULARY = "byte_bpe_50k.json"
CAPACITY, END_ID = 1024, 0
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Windows:
    """Open windows of one partition.  ``put`` returns the pieces whose place is final:
    (doc, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int, first_sequence: int, most_open: int = 4096):
        self.capacity, self.next, self.most_open = capacity, first_sequence, most_open
        self.level = np.zeros(capacity + 1, np.int64)  # open windows by fill level; 0 and capacity stay 0
        self.at: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def _sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def choose(self, size: int) -> int:
        """Level to fill up with ``size`` ids, 0 for a new window."""
        levels = np.flatnonzero(self.level[1:self.capacity - size + 1]) + 1
        after = 2 * self.level[levels + size] + 1
        after[levels + size == self.capacity] = 0
        change = np.append(after - 2 * self.level[levels] + 1, 2 * self.level[size] + 1)
        best = len(change) - 1 - int(np.argmin(change[:-1][::-1]) + 1) if len(levels) else 0
        return int(levels[best]) if len(levels) and change[best] <= change[-1] else 0

    def put(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        n, c = len(ids), self.capacity
        for start in range(0, n - n % c, c):
            yield doc, start, ids[start:start + c], n, self._sequence(), 0
        if not (size := n % c):
            return
        h = self.choose(size)
        window = self.at[h].pop() if h else []
        self.level[h] -= bool(h)
        self.open += not h
        window.append((doc, n - size, ids[n - size:], n))
        if h + size == c:
            self.open -= 1
            yield from self._lay(window, [c])
        else:
            self.level[h + size] += 1
            self.at[h + size].append(window)
            if self.open > self.most_open:
                yield from self.close(self.open // 2)

    def _lay(self, pieces: list[tuple], lengths: list[int]) -> Iterator[tuple]:
        """Lay pieces into sequences of these lengths, splitting where one ends."""
        todo = iter(lengths)
        free = at = sequence = 0
        for doc, start, ids, n in pieces:
            lo = 0
            while lo < len(ids):
                if not free:
                    free, at, sequence = next(todo), 0, self._sequence()
                take = min(free, len(ids) - lo)
                yield doc, start + lo, ids[lo:lo + take], n, sequence, at
                lo, free, at = lo + take, free - take, at + take

    def close(self, windows: int | None = None) -> Iterator[tuple]:
        """Close this many of the fullest windows (all by default) without padding."""
        left = self.open if windows is None else windows
        pieces: list[tuple] = []
        for h in range(self.capacity - 1, 0, -1):
            while left and self.at[h]:
                pieces += self.at[h].pop()
                self.level[h] -= 1
                self.open -= 1
                left -= 1
        total = sum(len(p[2]) for p in pieces)
        rest = total % self.capacity
        powers = [1 << k for k in range(self.capacity.bit_length() - 1, -1, -1) if rest >> k & 1]
        yield from self._lay(pieces, [self.capacity] * (total // self.capacity) + powers)


class ByteCodec:
    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.t.encode_special_tokens = True
        self.kind = "H" if self.t.get_vocab_size() <= 1 << 16 else "I"
        encode = JoinedEncoder(self.t, self.kind, "", lambda u: u[:1] in WHITE and u[-1:] not in WHITE)
        self.memo = SegmentCache(encode, split=None, most_segments=300_000)

    def encode(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        end = array(self.kind, [end_id]).tobytes()
        return [np.frombuffer(b + end, self.kind).astype("<u4") for b in self.memo(texts)]


@worker_cache
def byte_codec(path: str | None) -> ByteCodec:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one thread
    return ByteCodec(path)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (and the ids)."""
    docs = id_text(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        c, windows = byte_codec(vocabulary), Windows(capacity, TaskContext.get().partitionId() << 40)

        def rows(pieces: list[tuple], doc_type: pa.DataType) -> pa.RecordBatch:
            doc, start, ids, n, sequence, offset = zip(*pieces, strict=True)
            cols = [pa.array(doc, doc_type), *(pa.array(v, pa.int64()) for v in (
                start, map(len, ids), [zlib.crc32(np.ascontiguousarray(i)) for i in ids], n, sequence, offset))]
            if with_ids:
                cols.append(pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64())))
            return pa.record_batch(cols, names=[*PIECE, *["ids"] * with_ids])

        doc_type = None
        for b in batches:
            doc, text = arrow_columns(b, "doc_id", "text")
            doc_type = doc.type
            names = doc.to_pylist()
            for lo in range(0, len(names), 1_000):
                texts = text.slice(lo, 1_000).to_pylist()
                ids = (i for a, z in slices(texts) for i in c.encode(texts[a:z], end_id))
                done = [p for d, i in zip(names[lo:lo + 1_000], ids, strict=True) for p in windows.put(d, i)]
                if done:
                    yield rows(done, doc_type)
        if done := list(windows.close()):
            yield rows(done, doc_type)

    return map_arrow(docs, run, f"doc_id {kind}, " + ", ".join(f"{x} long" for x in PIECE[1:]) + ", ids array<long>" * with_ids)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
