"""Toxicity, quality and the pipeline."""
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinloom.llm import quality, toxicity, word_model

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 60))]
        toxic, junk = i % 5 == 0, i % 7 == 3
        for _ in range(4 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["scum", "moron", "idiot"])
        text = " ".join(w.upper() + "!!#" for w in words) if junk else " ".join(words)
        rows.append((i, text, "en" if i % 2 else "de", "s", len(text)))
        labels.append((i, int(not junk), int(toxic)))
    rows += [(n, "", "en", "s", 0), (n + 1, None, None, "s", 0), (None, "the and", "en", "s", 7), (n + 2, " .!", "xx", "s", 3), (n + 3, "the " * 20000, "en", "s", 80000)]
    labels += [(n, None, None), (None, 1, 1), (1, 1, 0)]
    return rows, labels


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rows, labels = corpus()
    d = str(tmp_path_factory.mktemp("llm"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_segments_against_all_intervals():
    """Ruzzo and Tompa: the segments are those of the recursive definition."""
    def recursive(x, lo, hi):
        best = max(((sum(x[a:b]), -(b - a), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0, 0))
        if best[0] <= 0:
            return []
        _, _, a, b = best
        return recursive(x, lo, a) + [(a, b - 1)] + recursive(x, b, hi)

    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 14)
        at = sorted(rng.sample(range(n), rng.randint(0, n)))
        w = [rng.choice([0.7, 1.3, 2.9, 4.1]) + rng.random() / 50 for _ in at]
        x = [-1.0] * n
        for p, v in zip(at, w, strict=True):
            x[p] = v
        got = toxicity.maximal_segments(at, w, -1.0)
        assert [(a, b) for a, b, _ in got] == recursive(x, 0, n)
        assert all(math.isclose(s, sum(x[a:b + 1])) for a, b, s in got)


def test_toxicity_held_out(spark, sf):
    got = {r.doc_id: r for r in toxicity.op5_toxicity(spark, sf).collect()}
    assert len(got) == 405
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [r for r in got.values() if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 40 and all(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    assert [got[i].predicted for i in (400, 401, 402, 403, None)] == [0] * 5


def test_labels_only_train(spark, sf):
    """Held-out labels and other columns do not move a score."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    a = toxicity.train(docs, labels, ~toxicity.held_out())
    b = toxicity.train(docs.withColumn("lang", F.lit("zz")), labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic"))), ~toxicity.held_out())
    assert a == b


def test_nothing_to_learn(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none, F.lit(True))
    assert toxicity.score(docs, model).agg(F.max("score")).first()[0] < 0.5
    assert toxicity.drop_toxic(docs, model).count() == docs.count()
    assert toxicity.score(docs.limit(0), model).count() == 0
    kept = quality.classify(docs, none)
    assert kept.count() == docs.count() and kept.where("not keep").count() == 0
    assert quality.classify(docs.limit(0), none).count() == 0


def reference_model(texts):
    """Modified Kneser-Ney in plain Python."""
    order = quality.ORDER
    counts = {order: Counter(g for t in texts for g in grams(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {}
    for k, c in counts.items():
        n = [0] + [sum(v == i for v in c.values()) for i in range(1, 5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        cut[k] = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) if n[i] else 0.5 * i for i in (1, 2, 3)]
    totals = {k: defaultdict(lambda: [0, 0.0]) for k in counts}
    for k, c in counts.items():
        for g, v in c.items():
            t = totals[k][g[:-1]]
            t[0] += v
            t[1] += cut[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        k = len(g)
        total, taken = totals[k].get(g[:-1], (0, 0.0))
        if not total:
            return p(g[1:])
        c = counts[k].get(g, 0)
        return (max(c - cut[k][min(c, 3) - 1], 0) if c else 0) / total + taken / total * p(g[1:])

    return p


def grams(text):
    b = b"\n" * (quality.ORDER - 1) + text
    return [b[i:i + quality.ORDER] for i in range(len(b) - quality.ORDER + 1)]


def test_perplexity_against_plain_model(spark, sf):
    rows, labels = corpus()
    good = {i for i, q, _ in labels if q == 1}
    p = reference_model([(t or "").encode() for i, t, *_ in rows if i in good and i is not None])
    docs, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality.classify(docs, lab, quantile=0.99).collect()}
    for i, text, *_ in rows[:30] + rows[-5:]:
        b = (text or "").encode()
        if not b:
            assert got[i].perplexity is None and got[i].keep
        else:
            want = math.exp(-sum(math.log(p(g)) for g in grams(b)) / len(b))
            assert math.isclose(got[i].perplexity, want, rel_tol=1e-4)
    junk = [i for i in range(400) if i % 7 == 3]
    assert all(not got[i].keep for i in junk)
    assert sum(not got[i].keep for i in range(400) if i % 7 != 3) <= 4


def test_blocks_of_any_size_score_alike(spark, sf):
    docs = quality.id_text(spark.read.parquet(f"{sf}/documents.parquet"), "lang")
    model = quality.kneser_ney(quality.count_grams(docs))
    a, b = ({r.doc_id: r.perplexity for r in quality.perplexity(docs, model, size).collect()} for size in (2_000, 10**9))
    assert a.keys() == b.keys() and all(a[i] == b[i] or math.isclose(a[i], b[i], rel_tol=1e-9) for i in a)


def test_gram_keys():
    keys, starts = quality.gram_keys([b"abcdef", b"", b"xy"])
    assert [int(k).to_bytes(5, "big") for k in keys] == [g for t in (b"abcdef", b"", b"xy") for g in grams(t)]
    assert starts.tolist() == [0, 6, 6]


def test_pipeline_stages(spark, sf):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows, _ = corpus()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality classifier", "n-gram Jaccard join", "PII", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns
        docs = corpus_pipeline.materialize(after)
    left = {r.doc_id for r in docs.collect()}
    clean = {i for i in range(400) if i % 5 and i % 7 != 3}
    assert not {i for i in range(0, 400, 5)} & left and not {i for i in range(400) if i % 7 == 3} & left
    assert len(clean - left) <= 4
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left


def test_word_model_grows_and_names_repeated_words(spark, sf):
    docs, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality.classify(docs, lab).collect()}
    assert (got[403].keep, got[403].reason) == (False, "repeated")
    assert got[400].keep and got[400].repeats is None and sum(r.reason == "repeated" for r in got.values()) == 1
    texts = quality.id_text(docs.where("doc_id < 400"))
    sizes = [quality.count_grams(texts.where(F.col("doc_id") < n), quality.WORDS).count() for n in (100, 200, 400)]
    assert sizes[1] > 1.7 * sizes[0] and sizes[2] > 1.7 * sizes[1]


def test_word_perplexity_against_plain_model(spark, sf):
    rows, _ = corpus()
    texts = [t.encode() for i, t, *_ in rows if t and i is not None and i < 200]
    keys, starts, sizes = quality.word_keys([b"a b c d", b"", b"a"])
    assert starts.tolist() == [0, 4, 4] and sizes.tolist() == [4, 0, 1] and keys[0] == keys[4] and len(set(keys.tolist())) == 4
    docs = quality.id_text(spark.read.parquet(f"{sf}/documents.parquet"))
    train = docs.where("doc_id < 200")
    model = quality.kneser_ney(quality.count_grams(train), quality.BYTES)
    words = quality.kneser_ney(quality.count_grams(train, quality.WORDS), quality.WORDS)
    packed = word_model.fit(train, quality.word_keys, 5)
    got = {r.doc_id: r.word_perplexity for r in quality.perplexity(docs, model, words=packed).collect()}
    wanted = {i: quality.word_keys([t.encode()])[0] for i, t, *_ in rows if t and i is not None}
    asked = spark.createDataFrame([(int(k),) for k in {int(k) for v in wanted.values() for k in v}], "key long")
    logp = {r.key: r.logp for r in quality.log_probs(asked, words, quality.WORDS, 3).collect()}
    assert len(texts) == 200
    for i, v in wanted.items():
        assert math.isclose(got[i], math.exp(-sum(logp[int(k)] for k in v) / len(v)), rel_tol=1e-4)


def test_waves_score_alike_and_leave_nothing(spark, tmp_path):
    import os

    from clinloom.session import checkpoint_dir

    texts = [" ".join(f"w{(i * k) % 37}" for k in range(40)) for i in range(60)]
    path = f"{tmp_path}/docs"
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    bytes_model = quality.kneser_ney(quality.count_grams(docs.select("text")))
    words = word_model.fit(docs.select("text"), quality.word_keys, 5)
    scores = lambda n: {r.doc_id: tuple(r) for r in quality.perplexity(docs, bytes_model, 2_000, words=words, waves=n).collect()}
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    once = scores(1)
    assert len(once) == 60 and scores(3) == once
    assert not [f for f in set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) - before if f.startswith("scores-")]


def test_only_equal_words_are_copies(spark):
    shared = "licensed under the terms of the zebra license "
    rows = [(i, shared + f"w{i} x{i} y{i}", i % 2) for i in range(40)] + [(100 + i, "Same words, here" if i % 2 else "same WORDS here!", 0) for i in range(6)]
    got = toxicity.one_of_copies(spark.createDataFrame(rows, "doc_id long, text string, toxic int")).collect()
    assert sorted(r.doc_id for r in got) == [*range(40), 100]


def test_all_significant_tokens_carry_weight(spark):
    counts = spark.range(30_000).select(F.col("id").cast("string").cast("binary").alias("token"), F.lit(600).cast("long").alias("toxic"), F.lit(0).cast("long").alias("clean"))
    clean = spark.range(30_000).select(F.concat(F.lit("c"), F.col("id")).cast("binary").alias("token"), F.lit(0).cast("long").alias("toxic"), F.lit(600).cast("long").alias("clean"))
    weights, top, rest = toxicity.token_weights(counts.union(clean), 10.0, 3.5, 2.0)
    assert len(weights) == len(top) == 30_000 and rest < 0


def test_word_lists_are_sorted_and_held_in_parts(spark, tmp_path, monkeypatch):
    """Distinct n-grams come from sorts, not from ``np.unique``'s hash table; a task holds a bounded number of
    n-grams; the parts of a block, and partitions scored by one task, change no score."""
    used = []
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda x, *a, **k: (used.append(bool(a or k)), unique(x, *a, **k))[1])
    keys = quality.word_keys([f"a{i % 7} b{i % 5} c{i}".encode() for i in range(200)])[0]
    rows = [r for b in word_model.asked(9, 2, word_model.distinct(keys), 3) for r in b.to_pylist()]
    assert not used and {r["part"] for r in rows} == {2} and {r["block"] for r in rows} == {9}
    for order, size in ((1, 212), (2, 435), (3, 600)):
        got = np.concatenate([word_model.unpack(r["keys"], np.int64, True) for r in rows if r["ord"] == order])
        assert len(got) == len(set(got.tolist())) == len({int(word_model.low(k, order)) for k in keys})
        assert order != 1 or len(got) == size
    monkeypatch.undo()
    path = f"{tmp_path}/docs"
    spark.createDataFrame([(i, " ".join(f"w{(i * k) % 37}" for k in range(40))) for i in range(60)], "doc_id long, text string").repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    bytes_model = quality.kneser_ney(quality.count_grams(docs.select("text")))

    def scores(waves):
        words = word_model.fit(docs.select("text"), quality.word_keys, 5)
        return {r.doc_id: r for r in quality.perplexity(docs, bytes_model, 2_000, words=words, waves=waves).collect()}

    whole = scores(2)
    monkeypatch.setattr(quality, "WORD_BYTES", 300)
    monkeypatch.setattr(word_model, "HELD_KEYS", 20)
    cut = scores(3)
    assert len(whole) == 60 and whole.keys() == cut.keys()
    assert all(math.isclose(whole[i].word_perplexity, cut[i].word_perplexity, rel_tol=1e-9) and whole[i].perplexity == cut[i].perplexity for i in whole)
