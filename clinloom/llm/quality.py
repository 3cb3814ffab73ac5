"""Quality by an interpolated modified Kneser-Ney n-gram model of trusted text.

There are two models: over bytes (order 5), for spelling, and over words (order 3), for
words that do not belong together.  A byte key is exact; a word key has three word hashes
of 21 bits each, so neither needs a vocabulary, and distinct word n-grams grow with the
input.  The word model counts nine tenths of the trusted documents, by a hash of doc_id: its
thresholds come from the others, as a counted document knows its own n-grams.  Training counts the n-grams of all trusted documents; lower orders count the
distinct bytes in front.  Discounts come from the counts of counts, and each order joins
its counts with its contexts' sums and with the next lower order, as tables dealt by key.

Scoring reads the texts three times.  For the byte model each task lists the distinct n-grams of
every block of documents; the lists of all blocks are joined with the tables of all
orders (back-off where one is unseen), and the probabilities go back to each block
as one file of a table partitioned by block.  The word model does the same with packed arrays
(``word_model.py``), some of the partitions at a time, and for a part of a block after the other.  Then each task scores its blocks with those
files.  So neither the model nor a text is broadcast or shuffled, and a block's file
is bounded by the block.  A block's name is a hash of its content: were it cut differently
the second time, its file would be missing and the task would fail.  The input should be
files or a written table.  Trusted texts are moved once, compressed, and tables that are read for the
last time are removed.

A document's perplexity is per byte, its word_perplexity per word, and repeats is the share
of words that equal one of the two before.  A language's threshold of each is a quantile
over that language's trusted documents (over all trusted documents where a language has
none) times a margin, that of repeats a quarter at least; documents above one are rejected.
``reason`` says why: repeated (words), bytes, words.

Defined results: a null or empty text has no perplexity and is kept; repeated rows score
alike; a null doc_id is scored but never trusted; a null language is one more language;
a document is trusted if any label row says quality 1; without trusted documents
nothing is rejected; other columns are ignored; an empty table gives an empty one.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm import word_model
from clinloom.llm.common import arrow_columns, id_text, map_arrow, table
from clinloom.llm.graph import IdFilter
from clinloom.llm.token_frames import open_store
from clinloom.llm.word_model import distinct
from clinloom.session import checkpoint_dir, discard, materialize, release_shuffles

ORDER = 5
BLOCK_BYTES = 16_000_000
WORD_BYTES = 6_000_000  # of a block's texts, for the words of which lists are made at a time
WAVES, WAVE_BYTES = 8, 64_000_000  # waves at most, and bytes of text that need no second one
_PAD = b"\n" * (ORDER - 1)
WORD_ORDER, WORD_BITS, _WORD = word_model.ORDER, word_model.BITS, word_model.WORD


def gram_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of each text (a text begins after line feeds),
    and the texts' offsets in them."""
    whole = np.frombuffer(b"".join([_PAD + t for t in texts]), np.uint8).astype(np.int64)
    keys = whole[ORDER - 1:].copy()
    for i in range(1, ORDER):
        keys |= whole[ORDER - 1 - i:len(whole) - i] << (8 * i)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    inside = np.ones(len(keys), bool)  # drop the n-grams that end in the next text's padding
    for k in range(ORDER - 1):
        inside[starts[1:] + (ORDER - 1) * np.arange(len(texts) - 1) + k] = False
    return keys[inside], starts


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word n-gram that ends at each word of each text (a text begins after zeros, which
    no word has), the texts' offsets in them and numbers of words."""
    import xxhash

    class Hashes(dict):
        def __missing__(self, word: bytes) -> int:
            self[word] = h = xxhash.xxh64_intdigest(word) % _WORD + 1
            return h

    cut = [t.split() for t in texts]
    sizes = np.array([len(c) for c in cut], np.int64)
    starts = np.cumsum(sizes) - sizes
    words = np.fromiter(map(Hashes().__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
    at = np.arange(len(words)) - np.repeat(starts, sizes)
    keys = words.copy()
    for i in range(1, WORD_ORDER):
        keys[i:] |= np.where(at[i:] >= i, words[:-i], 0) << (WORD_BITS * i)
    return keys, starts, sizes


@dataclass(frozen=True)
class Grams:
    """A kind of n-grams: its order, the bits of a symbol in a key, and its keys."""

    order: int
    bits: int
    keys: Callable


BYTES, WORDS = Grams(ORDER, 8, gram_keys), Grams(WORD_ORDER, WORD_BITS, word_keys)


def chunks(texts: list[bytes], most: int = 500_000) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > most:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def trusted_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, z): the compressed texts of trusted documents, written.  A bitmap of fixed size
    keeps most others from the join; the join decides."""
    near = IdFilter(trusted, "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for b in batches:
            some = b.filter(pa.array(near.passes(arrow_columns(b, "h")[0].to_numpy())))
            ids, text = arrow_columns(some, "doc_id", "text")
            yield pa.record_batch([ids, pa.array([zstandard.compress(t, 3) for t in text.cast(pa.binary()).to_pylist()], pa.binary())], names=["doc_id", "z"])

    thinned = map_arrow(docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("h")), run, f"doc_id {kind}, z binary")
    return materialize(thinned.join(trusted, "doc_id", "left_semi"))


def unpacked(texts: DataFrame) -> DataFrame:
    """The texts of ``trusted_texts`` as ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for b in batches:
            for lo in range(0, b.num_rows, 500):
                z = arrow_columns(b.slice(lo, 500), "z")[0].to_pylist()
                yield pa.record_batch([pa.array([zstandard.decompress(x) for x in z], pa.binary()).cast(pa.string())], names=["text"])

    return map_arrow(texts.select("z"), run, "text string")


def held_out() -> Column:
    """Trusted documents that the word model does not count."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0


def count_grams(texts: DataFrame, kind: Grams = BYTES) -> DataFrame:
    """(key, c): the n-grams of the highest order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)

        for b in batches:
            raw = arrow_columns(b, "text")[0].cast(pa.binary()).to_pylist()
            for lo, hi in chunks(raw):
                held.append(np.unique(kind.keys(raw[lo:hi])[0], return_counts=True))
                if len(held) >= 32:
                    held[:] = [merged()]
                    if len(held[0][0]) > 2_000_000:
                        yield pa.record_batch([pa.array(x) for x in held.pop()], names=["key", "c"])
        if held:
            yield pa.record_batch([pa.array(x) for x in merged()], names=["key", "c"])

    return map_arrow(texts, run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    r = counts.agg(*(F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5))).first()
    n = [0, *(float(r[f"n{i}"]) for i in range(1, 5))]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    return tuple(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) if n[i] else 0.5 * i for i in (1, 2, 3))


def kneser_ney(counts: DataFrame, kind: Grams = BYTES) -> tuple[list[DataFrame], list[DataFrame], float]:
    """Per order (from 1): probabilities (key, p) and back-off weights (key of the
    context, gamma); and the probability of an unseen byte."""
    c = {kind.order: materialize(counts)}
    for k in range(kind.order - 1, 0, -1):
        c[k] = materialize(c[k + 1].groupBy(F.col("key").bitwiseAND(F.lit((1 << kind.bits * k) - 1)).alias("key")).agg(F.count("*").alias("c")))
    probs, weights, unseen = [], [], 0.5 ** kind.bits
    for k in range(1, kind.order + 1):
        d1, d2, d3 = discounts(c[k])
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        rows = c[k].select("key", F.shiftright("key", kind.bits).alias("context"), (F.col("c") - cut).alias("left"), cut.alias("cut"), "c")
        sums = materialize(rows.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("gamma")))
        p = rows.join(sums, "context")
        if k == 1:
            p = p.select("key", (F.col("left") / F.col("total") + F.col("gamma") * unseen).alias("p"))
            first = sums.first()
            unseen *= first.gamma if first else 1.0
        else:
            lower = probs[-1].select(F.col("key").alias("suffix"), F.col("p").alias("q"))
            p = p.withColumn("suffix", F.col("key").bitwiseAND(F.lit((1 << kind.bits * (k - 1)) - 1))).join(lower, "suffix").select(
                "key", (F.col("left") / F.col("total") + F.col("gamma") * F.col("q")).alias("p"))
        probs.append(materialize(p))
        weights.append(sums.select(F.col("context").alias("key"), "gamma"))
    return probs, weights, unseen


def log_probs(asked: DataFrame, model: tuple[list[DataFrame], list[DataFrame], float],
              kind: Grams = BYTES, order: int = ORDER) -> DataFrame:
    """(key, logp) of n-grams of the given order, with back-off."""
    probs, weights, unseen = model
    out = asked.select("key").withColumn("p", F.lit(unseen))
    for k in range(1, order + 1):
        low = F.col("key").bitwiseAND(F.lit((1 << kind.bits * k) - 1))
        out = out.withColumn("g", low).join(probs[k - 1].select(F.col("key").alias("g"), F.col("p").alias("seen")), "g", "left")
        if k > 1:
            out = out.withColumn("h", F.shiftright("g", kind.bits)).join(weights[k - 1].withColumnRenamed("key", "h"), "h", "left")
            out = out.withColumn("p", F.col("p") * F.coalesce("gamma", F.lit(1.0))).drop("h", "gamma")
        out = out.withColumn("p", F.coalesce("seen", "p")).drop("g", "seen")
    return out.select("key", F.log("p").cast("float").alias("logp"))


def blocks(batches: Iterator[pa.RecordBatch], most: int, with_text: bool = False) -> Iterator[tuple[int, pa.Table, list[bytes]]]:
    """Runs of rows with about ``most`` bytes of text, within a ``dealt_part``: name, rows without
    texts, texts."""
    import xxhash

    rows, texts, size, part = [], [], 0, None

    def block() -> tuple[int, pa.Table, list[bytes]]:
        h = xxhash.xxh3_64(seed=part)
        for t in texts:
            h.update(t + b"\xff")
        return int(np.uint64(h.intdigest()).astype(np.int64)), pa.Table.from_batches(rows), texts

    def within(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Some hundred rows of a part at a time."""
        at = arrow_columns(b, "dealt_part")[0].to_numpy()
        cut = sorted({*range(0, len(at), 500), *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)})
        yield from (b.slice(lo, hi - lo) for lo, hi in pairwise(cut))

    for b in (x for b in batches for x in within(b)):
        now = arrow_columns(b, "dealt_part")[0][0].as_py()
        if texts and now != part:
            yield block()
            rows, texts, size = [], [], 0
        part = now
        raw = arrow_columns(b, "text")[0].cast(pa.binary()).to_pylist()
        rest, lo = b.select([n for n in b.schema.names if n != "dealt_part" and (with_text or n != "text")]), 0
        for i, t in enumerate(raw):
            texts.append(t)
            size += len(t)
            if size >= most:
                rows.append(rest.slice(lo, i + 1 - lo))
                yield block()
                rows, texts, size, lo = [], [], 0, i + 1
        if lo < len(raw):
            rows.append(rest.slice(lo))
    if texts:
        yield block()


def remove(folder: str) -> None:
    """Remove a written folder whose last reader is done."""
    store, root = open_store(folder)
    store.delete_dir(root)


def _with(score: Callable, word_folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return score(batches, word_folder)

    return run


def perplexity(docs: DataFrame, model: tuple[list[DataFrame], list[DataFrame], float], block_bytes: int = BLOCK_BYTES,
               with_text: bool = False, words: word_model.WordModel | None = None, waves: int | None = None) -> DataFrame:
    """The columns of ``docs`` (``text`` only if asked for), n_bytes and perplexity, of every
    row; with a model of words also n_words, word_perplexity and repeats.

    The word n-grams of a text take more room than the text.  So with a model of words the partitions
    of ``docs`` are scored in up to ``WAVES`` waves, whose lists and answers are removed before the next one;
    each wave's rows are written, and the result reads them."""
    spark = docs.sparkSession

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in blocks(batches, block_bytes):
            keys = distinct(np.concatenate([distinct(gram_keys(texts[lo:hi])[0]) for lo, hi in chunks(texts)]))
            yield pa.record_batch([pa.array(np.full(len(keys), name)), pa.array(keys)], names=["block", "key"])

    def word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in blocks(batches, block_bytes):
            for part, (a, z) in enumerate(chunks(texts, WORD_BYTES)):
                keys = distinct(np.concatenate([word_keys(texts[a + lo:a + hi])[0] for lo, hi in chunks(texts[a:z])]))
                yield from word_model.asked(name, part, keys, words.ranges)

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if with_text or f.name != "text")
    docs = docs.withColumn("dealt_part", F.spark_partition_id())
    asked = materialize(map_arrow(docs, grams, "block long, key long"))
    known = materialize(log_probs(asked.select("key").distinct(), model))
    release_shuffles(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/scores-{uuid.uuid4().hex}"
    asked.join(known, "key").repartition("block").write.partitionBy("block").parquet(folder)
    for t in (asked, known):
        discard(t)
    release_shuffles(spark)

    def score(batches: Iterator[pa.RecordBatch], word_folder: str | None = None) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        store, root = open_store(folder)
        word_store, word_root = open_store(word_folder) if word_folder else (None, None)
        for name, rows, texts in blocks(batches, block_bytes, with_text):
            sums, sizes = np.zeros(len(texts)), np.array([len(t) for t in texts], np.int64)
            if sizes.any():
                found = pq.read_table(f"{root}/block={name}", filesystem=store, columns=["key", "logp"], partitioning=None)
                keys, logp = found["key"].to_numpy(), found["logp"].to_numpy().astype(np.float64)
                order = np.argsort(keys)
                keys, logp = keys[order], logp[order]
                for lo, hi in chunks(texts):
                    asked, starts = gram_keys(texts[lo:hi])
                    some, at = np.unique(asked, return_inverse=True)
                    total = np.concatenate([[0.0], np.cumsum(logp[np.searchsorted(keys, some)][at])])
                    sums[lo:hi] = total[starts + sizes[lo:hi]] - total[starts]
            ppl = np.exp(-sums / np.maximum(sizes, 1))
            rows = rows.append_column("n_bytes", pa.array(sizes)).append_column("perplexity", pa.array(ppl, mask=sizes == 0))
            if word_folder:
                sums, again, sizes = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
                found = None
                for part, (a, z) in enumerate(chunks(texts, WORD_BYTES)):
                    cuts = [(a + lo, a + hi, *word_keys(texts[a + lo:a + hi])) for lo, hi in chunks(texts[a:z])]
                    triples, at = np.unique(np.concatenate([c[2] for c in cuts]), return_inverse=True)
                    if not len(triples):
                        continue
                    if found is None:
                        found = pq.read_table(f"{word_root}/block={name}", filesystem=word_store, columns=["part", "ord", "range", "counts", "sums"], partitioning=None)
                    logs, done = word_model.log_probs(triples, found.filter(pc.equal(found["part"], part)), words), 0
                    for lo, hi, asked, starts, n in cuts:
                        sizes[lo:hi] = n
                        word = asked & _WORD
                        same = (word == (asked >> WORD_BITS) & _WORD) | (word == asked >> 2 * WORD_BITS)
                        for out, x in ((sums, logs[at[done:done + len(asked)]]), (again, same)):
                            total = np.concatenate([[0.0], np.cumsum(x)])
                            out[lo:hi] = total[starts + n] - total[starts]
                        done += len(asked)
                none = sizes == 0
                rows = rows.append_column("n_words", pa.array(sizes))
                rows = rows.append_column("word_perplexity", pa.array(np.exp(-sums / np.maximum(sizes, 1)), mask=none))
                rows = rows.append_column("repeats", pa.array(again / np.maximum(sizes, 1), mask=none))
            yield from rows.combine_chunks().to_batches()

    more = ", n_words long, word_perplexity double, repeats double" if words else ""
    schema = f"{kept}, n_bytes long, perplexity double{more}"
    if not words:
        return map_arrow(docs, score, schema)
    if waves is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        waves = min(-(-size // WAVE_BYTES), WAVES) or 1
    tasks = -(-docs.rdd.getNumPartitions() // waves)  # a task for each partition of a wave, none for the others
    scored = []
    for wave in range(waves):
        own = docs.where(F.pmod("dealt_part", F.lit(waves)) == wave).coalesce(tasks) if waves > 1 else docs
        word_folder = f"{folder}-words-{wave}"
        lists = map_arrow(own, word_lists, "ord int, range int, block long, part int, keys binary")
        word_model.answers(lists, words).repartition("block").write.partitionBy("block").parquet(word_folder)
        release_shuffles(spark)
        scored.append(materialize(map_arrow(own, _with(score, word_folder), schema)))
        remove(word_folder)
    remove(folder)
    return reduce(DataFrame.union, scored)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, tuple, word_model.WordModel]:
    """(doc_id) of the trusted documents, and the byte and word models of their texts."""
    trusted = materialize(labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct())
    texts = trusted_texts(docs, trusted)
    model = kneser_ney(count_grams(unpacked(texts)))
    words = word_model.fit(unpacked(texts.where(~held_out())), word_keys)
    discard(texts)
    release_shuffles(docs.sparkSession)
    return trusted, model, words


MEASURES = (("perplexity", "threshold"), ("word_perplexity", "word_threshold"), ("repeats", "repeat_threshold"))


def judged(scored: DataFrame, trusted: DataFrame, quantile: float, margin: float, least_repeats: float = 0.25) -> DataFrame:
    """``scored`` (doc_id, lang, perplexity, ...) with the thresholds, reason and keep."""
    own = scored.where("perplexity is not null").join(trusted, "doc_id", "left_semi").select(
        "lang", "perplexity", F.when(held_out(), F.col("word_perplexity")).alias("word_perplexity"), "repeats")
    limit = [(F.percentile_approx(m, quantile, 10_000) * margin).alias(t) for m, t in MEASURES]
    of_lang = materialize(own.groupBy("lang").agg(*limit))  # a row per language
    overall = own.agg(*limit).first()
    named = of_lang.select(F.col("lang").alias("named"), *(F.col(t).alias(f"own_{t}") for _, t in MEASURES))
    out = scored.join(named, scored["lang"].eqNullSafe(named["named"]), "left")
    for _, t in MEASURES:
        out = out.withColumn(t, F.coalesce(f"own_{t}", F.lit(overall[t]).cast("double"))).drop(f"own_{t}")
    out = out.drop("named").withColumn("repeat_threshold", F.when(F.col("repeat_threshold").isNotNull(), F.greatest("repeat_threshold", F.lit(least_repeats))))
    reason = (F.when(F.col("repeats") > F.col("repeat_threshold"), "repeated").when(F.col("perplexity") > F.col("threshold"), "bytes")
              .when(F.col("word_perplexity") > F.col("word_threshold"), "words"))
    return out.withColumn("reason", reason).withColumn("keep", F.col("reason").isNull())


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.995, margin: float = 1.1) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, n_words, word_perplexity, repeats, their
    thresholds, reason and keep of every row of ``docs``."""
    docs = id_text(docs, F.col("lang").cast("string").alias("lang"))
    trusted, model, words = fit(docs, labels)
    return judged(perplexity(docs, model, words=words), trusted, quantile, margin)


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = 0.995, margin: float = 1.1) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``classify`` keeps.  The rows go
    along with their scores, so none has to be found again by a join."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*(F.col(c).alias(o) for c, o in zip(docs.columns, own, strict=True) if c != "text"), F.col("text").isNull().alias("no_text"),
                       "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    trusted, model, words = fit(rows, labels)
    kept = judged(perplexity(rows, model, with_text=True, words=words), trusted, quantile, margin).where("keep")
    text = F.when(~F.col("no_text"), F.col("text")).alias("text")
    return kept.select(*(text if c == "text" else F.col(o).alias(c) for c, o in zip(docs.columns, own, strict=True)))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
