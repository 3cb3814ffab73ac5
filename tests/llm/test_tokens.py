"""BPE codec, token files and packing against the tokenizer libraries."""
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinloom.llm import byte_bpe, packing, token_frames
from clinloom.llm.common import JoinedEncoder, SegmentCache, segments, units

TEXTS = ["", None, "Hello world, it's they'll  go\n\n now \t x.", "a  b   c \n \n d\xa0 e\x1c f", "x" * 3000 + " " + "ab" * 900,
         "日本語 のテキスト。 ÉÀ ß İ| İ! 12345 6", "same text", "same text", " \n", "<|endoftext|> plain", "word " * 4000]
SCHEMA = "doc_id long, text string, source string, token string, ids string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s", "clash", "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", "s", None, None), (6, "same text", "s", None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    e = byte_bpe.codec(None, None)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=e.ranks, special_tokens={})


def test_segments_concatenate_to_the_text():
    for t in TEXTS:
        assert "".join(segments(t or "")) == (t or "")
        assert all("".join(units(s)) == s for s in segments(t or ""))


def test_memo_forgets_without_changing_results():
    memo = SegmentCache(lambda us: [u.encode() for u in us], most_segments=2, most_units=2)
    for _ in range(3):
        assert memo(["a b c d\ne", "b  c, d."]) == [b"a b c d\ne", b"b  c, d."]


def test_joined_units_have_their_own_ids():
    """Units encoded as one text, in any grouping, and units whose common ids cannot be cut."""
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    units = ["ab", "it's", "", "İx", "Straße", "straße", "e\u0301", "日本語", "12345", "x" * 500, "\x1c\x1d", "don't.", "<|endoftext|>", "\x00"]
    want = [np.array(t.encode(u, add_special_tokens=False).ids, "<u2").tobytes() for u in units]
    for together in (1, 3, 100):
        assert JoinedEncoder(t, "H", " ", token_frames.word_codec(None)._stays, "</w>")(units, together) == want
    assert JoinedEncoder(t, "H", "", lambda u: True, "</w>")(["th", "e"]) == [np.array(t.encode(u, add_special_tokens=False).ids, "<u2").tobytes() for u in ("th", "e")]


def test_segments_of_texts():
    """Single spaced and other texts in one call, in order; empty calls and texts."""
    cache = SegmentCache(lambda us: [u.encode() + b"|" for u in us], split=None)
    assert cache([]) == []
    assert cache(["", "a b", "\n", " ", "a  b", "b\nc d ", "\nb", "a\tb é\u3000"]) == [
        b"|", b"a| b|", b"|\n|", b"| |", b"a|  b|", b"b|\nc| d| |", b"|\nb|", b"a|\tb| \xc3\xa9|\xe3\x80\x80|"]


def test_encode_decode(docs, library):
    got = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert r.ids == library.encode_ordinary(text) and bytes(r.decoded) == text.encode()


def test_codec_random_strings(library):
    rng = np.random.default_rng(3)
    letters = list("aB é\n  .,|!'sSÉß\x1c\xa0漢12ΣςIİ-\t")
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(1500)]
    c = byte_bpe.codec(None, None)
    assert [i.tolist() for i in c.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    for name, codec, kind in (("word_bpe_49k.json", token_frames.word_codec(None).encode, "<u2"), ("byte_bpe_50k.json", lambda t: packing.byte_codec(None).encode(t, 0), None)):
        t = Tokenizer.from_file(public_tokenizers.path(name))
        t.encode_special_tokens = True
        want = [t.encode(x, add_special_tokens=False).ids for x in texts]
        got = codec(texts)
        assert [np.frombuffer(g, kind).tolist() if kind else g.tolist()[:-1] for g in got] == want


def test_long_texts_decode_in_ranges(tmp_path, monkeypatch):
    """A document of millions of ids; nothing is written beside it."""
    monkeypatch.chdir(tmp_path)
    c = byte_bpe.codec(None, None)
    ids = np.arange(3_000_000, dtype=np.int32) % 50_000
    out = byte_bpe.decoded_texts(c, [ids[:0], ids[:3], ids, ids[:5]])
    assert out[2] == b"".join(map(c.names.__getitem__, ids.tolist())) and out[0] == b"" and out[1] + out[3][len(out[1]):] == out[3]
    assert not list(tmp_path.iterdir())


def test_decode_rejects_unknown_ids(spark):
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [60000])], "doc_id long, ids array<int>")).collect()


def test_op2_digests(spark, docs, library, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    for r in byte_bpe.op2_byte_bpe(spark, str(tmp_path)).collect():
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_token_files(docs, tmp_path):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    manifest = token_frames.write_tokens(docs, str(tmp_path / "out"), shards=3)
    got = sorted(token_frames.read_tokens(manifest, frames_per_task=2, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 0, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10]
    at = 0
    for r in got:
        ids = t.encode("no id" if r.doc_id is None else TEXTS[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.ids, r.n_tokens, r.ids_crc32) == (at, ids, len(ids), zlib.crc32(np.array(ids, "<u4")))
        at += len(ids)
    path = next(r.path for r in manifest.collect() if r.start == 0)
    reader = token_frames.ShardReader(path)
    assert [len(reader.find(0)), len(reader.find(99))] == [1, 0]


def test_damaged_frame_is_found(tmp_path):
    import zstandard

    raw = np.arange(50, dtype="<u2").tobytes()
    row = token_frames.write_shard(str(tmp_path), 0, 2, iter([(7, len(raw), zstandard.compress(raw), token_frames._sum32(raw) ^ 1)]))
    with pytest.raises(ValueError, match="checksum"):
        token_frames.ShardReader(row[1]).frame(0)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.decode(byte_bpe.encode(none)).count() == 0
    assert packing.pack(none).count() == 0
    assert token_frames.read_tokens(token_frames.write_tokens(none)).count() == 0


def test_packing_is_whole(docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = packing.pack(docs, with_ids=True).collect()
    whole = {}
    for r in rows:
        whole.setdefault((r.doc_id, r.doc_tokens), {}).setdefault(r.start, []).append(r.ids)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4"))
    for i, text in enumerate(TEXTS):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        if i != 6:
            parts = whole[i, len(ids)]
            assert [x for s in sorted(parts) for x in parts[s][0]] == ids and all(len(p) == 1 for p in parts.values())
    check_sequences(rows)


def check_sequences(rows, capacity=1024):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)  # no padding at all


def test_level_choice_minimises_sum_of_squares():
    rng = np.random.default_rng(1)
    w = packing.Windows(64, 0)
    for _ in range(300):
        size = int(rng.integers(1, 64))
        level = w.level.copy()
        chosen = w.choose(size)

        def after(h):
            n = level.copy()
            n[h] -= bool(h)
            n[h + size] += h + size < 64
            return (n ** 2).sum()

        options = [0] + [h for h in range(1, 64 - size + 1) if level[h]]
        assert after(chosen) == min(map(after, options))
        list(w.put(0, np.arange(size)))


def test_many_open_windows_are_closed():
    w = packing.Windows(1024, 0, most_open=10)
    out = [p for i in range(200) for p in w.put(i, np.arange(600))]
    assert w.open <= 10
    out += list(w.close())
    assert sum(len(p[2]) for p in out) == 200 * 600 and w.open == 0
