"""N-gram join against all pairs."""
import itertools
import random

import numpy as np
import pytest

from clinloom.llm import graph, ngram_join

SCHEMA = "doc_id long, text string, n long, cls string, rep string"


def shingle_set(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {i: shingle_set(t or "") for i, t in rows if i is not None}
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            p, q = find(a), find(b)
            comp[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed):
    """Groups of copies with edits, a passage in many texts, chains, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []

    def add(words):
        rows.append((len(rows) * 3, " ".join(words)))

    for size, edits in ((60, 3), (12, 1), (5, 6)):
        base = [word() for _ in range(120)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(120)] = word()
            add(copy)
            if rng.random() < 0.3:
                add(copy)
    for _ in range(40):
        add([word() for _ in range(rng.randint(5, 80))] + passage)
    chain = [word() for _ in range(100)]
    for k in range(12):  # each links with the next few only
        add(chain[k * 3:] + [f"x{i}" for i in range(k * 3)])
    rows += [(5001, ""), (5002, None), (5003, "one two"), (5004, "ONE  two"), (5005, "one two three four five"), (5006, "\x1c"), (5007, "\xa0 é"),
             (5008, "É"), (5009, "é"), (None, "one two"), (None, None), (5010, " \t\n")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in rows], SCHEMA).repartition(5)
    got = ngram_join.jaccard_components(docs).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        assert (r.component_id is None) if r.doc_id is None else (r.n_shingles, r.component_id) == want[r.doc_id], r


def test_repeated_rows_and_stay(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(4, text), (4, text), (2, text + " end"), (9, "other words"), (None, text), (7, None), (7, None)]
    docs = spark.createDataFrame([(i, t, 1, "c", "r") for i, t in rows], SCHEMA)
    got = {(r.doc_id, r.component_id, r.class_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {(4, 2, 4), (2, 2, 2), (9, 9, 9), (None, None, None), (7, 7, 7)}
    stay = ngram_join.one_of_each(docs)
    assert stay.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in stay.collect() if r.text) == [(-1, text), (2, text + " end"), (9, "other words")]
    assert stay.where("doc_id = 7").count() == 1


def test_empty(spark):
    assert ngram_join.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_prefix_lemma():
    """Sets above the threshold share at least min(l, l') prefix shingles."""
    rng = np.random.default_rng(0)
    for _ in range(400):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 62, n)).astype(np.uint64)
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.08], rng.integers(0, 1 << 62, rng.integers(0, 5)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 80 * (len(a) + len(b) - both):
            continue
        weight = lambda s: (s % np.uint64(7)).astype(np.int64)
        (pa, la), (pb, lb) = (ngram_join.prefix(s, weight(s), 0.0, 80, 4) for s in (a, b))
        assert len(np.intersect1d(a[pa], b[pb])) >= min(la, lb)


def test_late_common_tokens_make_no_rows(spark):
    """A group and near copies that are too far from it meet in the same lists, behind too many
    own tokens; a pair that fits is found once, whatever else it shares."""
    near = [(t, c, 146, 8 + t, 4, 0) for c in range(40) for t in range(5)]
    far = [(t, c, 146, 18 + t, 4, c) for c in range(100, 140) for t in range(5)]
    fits = [(t, 200, 146, 5 + t, 4, 200) for t in range(5)]
    lists = spark.createDataFrame(near + far + fits, "token long, cls long, n long, pos long, asked long, comp long")
    made = ngram_join.meetings(lists, 80).collect()
    assert {r.cls_a for r in made} == {200} and {r.cls_b for r in made} == set(range(40))
    assert sorted(map(tuple, ngram_join.remaining(lists, 80).collect())) == [(c, 200) for c in range(40)]


def test_chain_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 999), (7000, 1000)]
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 999: 999, 1000: 999, 7000: 999}


def test_id_filter_misses_none(spark):
    from pyspark.sql import functions as F

    ids = spark.range(0, 5000, 7).withColumnRenamed("id", "doc_id")
    f = graph.IdFilter(ids, "doc_id")
    h = np.array([r.h for r in ids.select(F.xxhash64("doc_id").alias("h")).collect()])
    other = np.array([r.h for r in spark.range(100000, 101000).select(F.xxhash64("id").alias("h")).collect()])
    assert f.passes(h).all() and f.passes(other).mean() < 0.01


@pytest.mark.parametrize("shape", ["chain", "star", "random", "cliques"])
def test_components_of_any_shape(spark, shape):
    """Links in three portions against union-find: a chain in order is the longest way to its root."""
    rnd = random.Random(3)
    links = {"chain": [(i, i + 1) for i in range(300)], "star": [(150, i) for i in range(300)],
             "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)],
             "cliques": [(a, b) for k in range(0, 300, 12) for a in range(k, k + 12) for b in range(a, k + 12)]}[shape]
    rnd.shuffle(links)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    labels = None
    for portion in (links[:100], links[100:101], links[101:]):
        for a, b in portion:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        labels = graph.joined_components(labels, spark.createDataFrame(portion, "a long, b long"))
        got = {r.node: r.comp for r in labels.collect()}
        alone = {x for x in root if x not in got}
        assert got == {x: find(x) for x in root if x not in alone} and all(find(x) == x for x in alone)


def test_pairs_that_outlines_exclude_move_no_prefix(spark, monkeypatch):
    """Of texts that meet in a list, only pairs whose outlines allow a link are looked at further."""
    rows = [(7, c, 10, 0, 1, c) for c in range(1, 9)]
    lists = ngram_join.materialize(spark.createDataFrame(rows, "token long, cls long, n long, pos long, asked long, comp long"))
    outline = lambda c: bytes(10 * (i == (0 if c in (2, 5) else c)) for i in range(256))
    classes = spark.createDataFrame([(c, c, 10, bytearray(outline(c))) for c in range(1, 9)], "cls long, rep long, n long, outline binary")
    written, materialize = [], ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", lambda df: (written.append(materialize(df)), written[-1])[1])
    verify = ngram_join.Verifier(None, classes, 5, 80)
    assert [tuple(r) for r in ngram_join.remaining(lists, 80, verify).collect()] == [(2, 5)]
    assert [t.count() for t in written if t.columns == ["cls", "tokens"]] == [2]
    assert ngram_join.remaining(lists, 80).count() == 28
