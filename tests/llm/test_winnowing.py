"""Decontamination by winnowing against all windows by brute force."""
import random
import re

from pyspark.sql import functions as F

from clinloom.llm import winnowing as W

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans(W.UPPER, W.LOWER)


def brute(docs, items):
    cut = lambda t: WORDS.findall((t or "").translate(LOW))
    windows = {}
    for i, t in items:
        w = cut(t)
        m = min(10, len(w))
        for a in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[a:a + m]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for m in {len(k) for k in windows}:
            for a in range(len(w) - m + 1):
                if (x := windows.get(tuple(w[a:a + m]))) is not None:
                    hit |= set(range(a, a + m))
                    found |= x
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


def got(spark, docs, items):
    d = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, item_id string, anchors int").repartition(3)
    i = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id int, text string, doc_id string")
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in W.contamination(d, i).collect()), key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(5)
    for vocabulary, lengths in ((3, [10, 12, 30]), (2, [1, 2, 3, 4, 5, 6, 8, 9, 10, 15]), (40, [4, 9, 10, 25])):
        text = lambda n: " ".join(rnd.choice(["Ab{}", "é{}", "z{}"]).format(rnd.randrange(vocabulary)) for _ in range(n))
        items = [(k % 17, text(rnd.choice(lengths))) for k in range(25)] + [(None, text(11)), (40, None), (41, "--"), (42, items_text := text(12)), (43, items_text)]
        docs = [(k, text(rnd.choice([0, 3, 9, 10, 60]))) for k in range(40)]
        for k in range(40):
            whole = rnd.choice(items)[1] or ""
            piece = whole.split()[rnd.randrange(3):]
            docs.append((100 + k, text(rnd.randrange(20)) + " , " + ("...".join(piece[:len(piece) - rnd.randrange(3)])).upper() + " " + text(5)))
        docs += [(0, docs[0][1]), (None, items_text), (None, None), (900, ("x0 " * 5000) + items_text + " y" * 5000)]
        assert got(spark, docs, items) == brute(docs, items)


def test_empty_sides(spark):
    docs = [(1, "a b c d e f g h i j k")]
    assert got(spark, docs, []) == [(1, 11, 0, [])]
    assert got(spark, [], [(1, docs[0][1])]) == []
    assert got(spark, docs, [(1, docs[0][1])]) == [(1, 11, 11, ["1"])]


def test_every_span_keeps_a_common_gram(spark):
    """Two texts with a common span of SPAN words keep a common k-gram inside it."""
    rnd = random.Random(2)
    words = lambda n: [str(rnd.randrange(9)) for _ in range(n)]
    rows = []
    for _ in range(200):
        span = words(W.SPAN)
        rows += [(words(rnd.randrange(12)) + span + words(rnd.randrange(12)), words(rnd.randrange(12)) + span + words(rnd.randrange(12)))]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    kept = lambda c: F.transform(W.anchors(F.col(c), W.SIZE, lambda g, m: F.filter(g, lambda x: W.is_kept(x, m))), lambda x: x["key"])
    out = df.select(kept("a").alias("a"), kept("b").alias("b"))
    assert out.where("not arrays_overlap(a, b)").count() == 0
    assert out.agg(F.sum(F.size("a"))).first()[0] < 0.6 * sum(len(a) for a, _ in rows)
