"""Token ids in zstandard files whose frames are read one by one.

File: for each document, in ascending doc_id order, one zstandard frame of its ids
(little-endian unsigned integers of ``width`` bytes); then one skippable frame with
the width and the documents' ids; then the seek table of the zstandard seekable
format, a skippable frame of (compressed size, decompressed size, low 32 bits of the
frame's XXH64) per frame, which ends with the number of frames.  A reader fetches the
two trailing frames and then only the frames it wants; each is checked against its
checksum.

Writing: ids are compressed where they are made, stored once, dealt by doc_id range,
sorted, and appended; a file appears under its name when it is complete, so a task that
is run again replaces it.  A manifest row per file carries the ids before it.

Defined results: a null text counts as empty (its only id is the end id); rows with the
same doc_id stand side by side, shorter ones first, then by their frames' bytes; rows
with a null doc_id come first; an empty table gives an empty manifest; other columns
are ignored.
"""
from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinloom.llm.common import WHITE, JoinedEncoder, SegmentCache, arrow_columns, id_text, map_arrow, slices, table, units, worker_cache
from clinloom.session import checkpoint_dir, materialize

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SKIP_INDEX, SKIP_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
NULL_ID = -(1 << 63)
MANIFEST = "shard int, path string, frames long, tokens long, bytes long"


class WordCodec:
    def __init__(self, path: str | None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.t.encode_special_tokens = True
        self.width = 2 if self.t.get_vocab_size() <= 1 << 16 else 4
        encode = JoinedEncoder(self.t, "H" if self.width == 2 else "I", " ", self._stays, "</w>")
        self.encode = SegmentCache(encode, self._units)

    def _stays(self, unit: str) -> bool:
        """The normaliser keeps the unit's length.  It has no white space, and pre-tokens end at a space."""
        return unit != "" and (unit.isascii() or self.t.normalizer.normalize_str(unit) == unit)

    @staticmethod
    def _units(segment: str) -> list[str]:
        """The vocabulary drops white space and case, so neither makes a new unit."""
        seen = segment.strip(WHITE)
        if "\u0130" in seen:  # its lower case ends in a mark that joins what follows
            return [seen]
        return [u.lower() if u.isascii() else u for u in units(seen)] if seen else [""]


@worker_cache
def word_codec(path: str | None) -> WordCodec:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one thread
    return WordCodec(path)


def open_store(uri: str):
    """File system and path of a shared folder: any store that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _sum32(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def write_shard(folder: str, shard: int, width: int, rows: Iterator[tuple[int | None, int, bytes, int]]) -> tuple:
    """Append the frames (doc_id, size, frame, checksum) to one file; its manifest row."""
    store, root = open_store(folder)
    name = f"{root}/tokens-{shard:06d}.zst"
    part = f"{name}.{uuid.uuid4().hex}"
    docs, seek, total, size = [], bytearray(), 0, 0
    with store.open_output_stream(part, compression=None) as out:
        for doc, raw, frame, check in rows:
            out.write(frame)
            docs.append(NULL_ID if doc is None else doc)
            seek += struct.pack("<III", len(frame), raw, check)
            total, size = total + raw // width, size + len(frame)
        index = struct.pack("<B", width) + np.array(docs, "<i8").tobytes()
        tail = (struct.pack("<II", SKIP_INDEX, len(index)) + index + struct.pack("<II", SKIP_SEEK, len(seek) + 9)
                + bytes(seek) + struct.pack("<IBI", len(docs), 0x80, SEEK_MAGIC))
        out.write(tail)
    store.move(part, name)
    return shard, name if "://" not in folder else f"{folder}/tokens-{shard:06d}.zst", len(docs), total, size + len(tail)


class ShardReader:
    """Random access to one file."""

    def __init__(self, path: str):
        store, name = open_store(path)
        self.file = store.open_input_file(name)
        end = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError(f"{path} has no seek table")
        at = end - 9 - 12 * n - 8
        seek = np.frombuffer(self._at(at + 8, 12 * n), "<u4").reshape(n, 3)
        at -= 8 + 1 + 8 * n
        head, length = struct.unpack("<II", self._at(at, 8))
        if head != SKIP_INDEX or length != 1 + 8 * n:
            raise ValueError(f"{path} has no document index")
        index = self._at(at + 8, length)
        self.width, self.docs = index[0], np.frombuffer(index[1:], "<i8")
        self.sizes, self.checks = seek[:, 1].astype(np.int64), seek[:, 2]
        self.ends = np.cumsum(seek[:, 0].astype(np.int64))
        self.starts = (np.cumsum(self.sizes) - self.sizes) // self.width

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def frame(self, i: int) -> np.ndarray:
        import zstandard

        lo = int(self.ends[i - 1]) if i else 0
        raw = zstandard.ZstdDecompressor().decompress(self._at(lo, int(self.ends[i]) - lo), max_output_size=int(self.sizes[i]))
        if _sum32(raw) != self.checks[i]:
            raise ValueError(f"frame {i} fails its checksum")
        return np.frombuffer(raw, f"<u{self.width}")

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every document of this id; only their frames are read."""
        lo, hi = np.searchsorted(self.docs, [doc_id, doc_id + 1])
        return [self.frame(i) for i in range(lo, hi)]


def write_tokens(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, shards: int | None = None) -> DataFrame:
    """Write the ids of every document below ``folder`` (a new one in the shared
    folder by default); the manifest: shard, path, frames, tokens, bytes, start."""
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    docs = id_text(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        c, z = word_codec(vocabulary), zstandard.ZstdCompressor(level=3, write_content_size=True)
        end = END_ID.to_bytes(c.width, "little")
        for b in batches:
            doc, text = arrow_columns(b, "doc_id", "text")
            texts = text.to_pylist()
            for lo, hi in slices(texts):
                raw = [x + end for x in c.encode(texts[lo:hi])]
                yield pa.record_batch([doc.slice(lo, hi - lo), pa.array(map(len, raw), pa.int64()),
                                       pa.array(map(z.compress, raw), pa.binary()),
                                       pa.array(map(_sum32, raw), pa.int64()),
                                       pa.array([c.width] * len(raw), pa.int32())],
                                      names=["doc_id", "size", "frame", "checksum", "width"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        width = 0

        def rows():
            nonlocal width
            for b in batches:
                if b.num_rows:
                    width = b.column(4)[0].as_py()
                yield from zip(*(c.to_pylist() for c in b.columns[:4]), strict=True)

        it = rows()
        if (first := next(it, None)) is not None:
            from itertools import chain

            row = write_shard(folder, TaskContext.get().partitionId(), width, chain([first], it))
            yield pa.record_batch([pa.array([v]) for v in row], names=["shard", "path", "frames", "tokens", "bytes"]).cast(
                pa.schema([("shard", pa.int32()), ("path", pa.string()), ("frames", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]))

    frames = materialize(map_arrow(docs, compress, f"doc_id {kind}, size long, frame binary, checksum long, width int"))
    dealt = frames.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "size", "frame")
    manifest = materialize(map_arrow(dealt, write, MANIFEST))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return materialize(manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))))


def read_tokens(manifest: DataFrame, frames_per_task: int = 20_000, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    spark = manifest.sparkSession
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("frames") - 1, F.lit(frames_per_task).cast("long")))
    work = manifest.where("frames > 0").select("path", "start", at.alias("lo")).repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "lo")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, lo in zip(*(c.to_pylist() for c in b.columns), strict=True):
                r = ShardReader(path)
                hi = min(lo + frames_per_task, len(r.docs))
                for a in range(lo, hi, 2_000):
                    span = range(a, min(a + 2_000, hi))
                    ids = [r.frame(i).astype("<u4") for i in span]
                    cols = [pa.array([None if d == NULL_ID else d for d in r.docs[a:span.stop].tolist()], pa.int64()),
                            pa.array(start + r.starts[a:span.stop]), pa.array(map(len, ids), pa.int64()),
                            pa.array([zlib.crc32(i) for i in ids], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols, names = [*cols, pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64()))], [*names, "ids"]
                    yield pa.record_batch(cols, names=names)

    return map_arrow(work, read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def op3_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(table(spark, sf_dir, "documents")))
