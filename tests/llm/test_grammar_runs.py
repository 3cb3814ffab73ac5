"""Run detection on a grammar against brute force over all periods."""
import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from clinloom.llm import grammar_runs as G


def brute(w):
    """(start, length, period) of all runs: maximal stretches that equal themselves q words on."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            e = i + q
            if e - s >= max(6, 4 * q) and not any(q % p == 0 and w[s:e - p] == w[s + p:e] for p in range(1, q)):
                out.append((s, e - s, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(docs):
    words = G.Words.of(docs)
    first = np.concatenate([[0], words.ends])
    out = [[] for _ in docs]
    for b, e, q in zip(*(x.tolist() for x in G.runs(words)), strict=True):
        d = int(np.searchsorted(words.ends, b, side="right"))
        out[d].append((b - int(first[d]), e - b, q))
    return out


def made(rnd):
    k = rnd.choice([1, 2, 2, 3, 5, 50])
    word = lambda: b"%d" % rnd.randrange(k)
    doc = [word() for _ in range(rnd.choice([0, 1, 3, 6, 10, 30, 80]))]
    for _ in range(rnd.randrange(4)):
        unit = [word() for _ in range(rnd.randrange(1, 12))] * rnd.randrange(2, 9)
        piece = unit[:rnd.randrange(len(unit) + 1)]
        for _ in range(rnd.randrange(1, 3)):  # the same run at two places is one rule's
            at = rnd.randrange(len(doc) + 1)
            doc[at:at] = piece
        doc *= rnd.choice([1, 1, 2])
    return doc[:400]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        docs = [made(rnd) for _ in range(rnd.randrange(1, 8))]
        assert found(docs) == [brute(d) for d in docs]


def test_grammar_derives_the_text():
    """Every rule's moves are places of equal words, and no pair is left twice."""
    rnd = random.Random(9)
    docs = [made(rnd) for _ in range(30)]
    words = G.Words.of(docs)
    nodes = G.repair(words)
    for node in nodes[:-1]:
        for b, by in zip(*(m.tolist() for m in node.moves), strict=True):
            s, e = int(node.start[b]), int(node.end[b])
            assert (words.ids[s:e] == words.ids[s + by:e + by]).all()
    assert len(nodes[-1].at) == len(set(nodes[-1].at.tolist()))


def test_long_texts():
    one = G.runs(G.Words.of([[b"der"] * 300_000]))
    assert [x.tolist() for x in one] == [[0], [300_000], [1]]
    rnd = random.Random(1)
    unit = [b"%d" % rnd.randrange(1000) for _ in range(20_000)]
    long = G.runs(G.Words.of([unit * 5]))
    assert [x.tolist() for x in long] == [[0], [100_000], [20_000]]
    coin = [b"ab"[rnd.randrange(2):][:1] for _ in range(3_000)]
    assert found([coin]) == [brute(coin)]


def test_query(spark, tmp_path):
    same = "a b c " * 9
    texts = [None, "", "\t \n", same, same, "x " * 7 + same + "é é " * 5, "one two three", "A a A a A a A a", " ".join(str(i % 7) for i in range(3_000))]
    rows = [(i, t) for i, t in enumerate(texts * 4)] + [(None, same), (3, same)]
    for name, data in (("documents", rows), ("empty", [])):
        spark.createDataFrame([(i, t, "clash", "clash") for i, t in data], "doc_id long, text string, runs string, start string").write.parquet(str(tmp_path / name / "documents.parquet"))
    got = sorted(map(tuple, G.op11_grammar_runs(spark, str(tmp_path / "documents")).collect()), key=str)
    sha = lambda t: hashlib.sha256(t).hexdigest()
    expected = []
    for i, t in rows:
        w = (t or "").encode().split()
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[j if j < a else a + (j - a) % p] for j in range(len(w))]
        r = brute(w)
        best = max(r, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        kept = b" ".join(x for j, x in enumerate(w) if not any(s + q <= j < s + n for s, n, q in r))
        expected.append((i, len(r), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                         sha("".join(f"{s},{n},{q}\n" for s, n, q in r).encode()), sha(kept)))
    assert got == sorted(expected, key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in rows if t)
    assert G.op11_grammar_runs(spark, str(tmp_path / "empty")).count() == 0
