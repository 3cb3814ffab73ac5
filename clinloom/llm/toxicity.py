"""Toxicity by maximum-scoring segments over token log-odds.

Training: the documents of the labelled rows given (at most about ``most_labelled`` of
them, chosen by a hash of their id) are counted by token and class, one count per document and
one document of each group of equal words (case and marks aside); the log-odds of a token between the classes has an informative Dirichlet prior, ``prior``
tokens spread like the whole corpus and half a token each, and its z-score says whether it is significant.
All significant toxic tokens carry their log-odds, however many they are; all other tokens
share one slightly negative weight, that of the rest of the mass.  A token is a word and,
if the word is not significant by itself, its first five letters.

Scoring: one linear scan per document finds every maximal segment of positive total
(Ruzzo and Tompa).  A segment of score S in n tokens has the E-value K n exp(-lambda S)
of extreme-value statistics: lambda makes the clean tokens' expected exp(lambda * weight)
one, K comes from the best segments of clean training documents.  Significant segments
add up -ln E; a logistic curve fitted to the training documents maps that to 0..1.

Labels are used in training only; lang, source and doc_id never enter a score.

Defined results: a null or empty text, and one without words, has the score of a
document without any toxic segment; repeated rows score alike; a null doc_id stays null;
repeated labels of a document count as one, toxic if any is; null labels are left out;
other columns are ignored; an empty table gives an empty one.  Without both classes among
the training rows nothing is learned, and every score is 0.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import arrow_columns, each_text, id_text, map_arrow, table
from clinloom.session import materialize

_WORDS = bytes(i + 32 if 65 <= i <= 90 else i if i > 127 or chr(i).isalnum() else 32 for i in range(256))
STEM = "\x00"  # marks a token that stands for the beginning of a word
STEM_LETTERS = 5


def words(text: str) -> list[bytes]:
    """Runs of letters and digits, A-Z in lower case, as UTF-8."""
    return text.encode().translate(_WORDS).split()


def stem(word: bytes) -> bytes | None:
    head = word.decode("utf-8", "replace")[:STEM_LETTERS].encode()
    return STEM.encode() + head if len(head) < len(word) else None


def maximal_segments(positions: list[int], weights: list[float], rest: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence in which the
    given positions have these positive weights and all others ``rest`` < 0."""
    out: list[list[float]] = []  # [first, last, total before, total after]
    total, last = 0.0, -1
    for p, w in zip(positions, weights, strict=True):
        total += rest * (p - last - 1)
        seg = [p, p, total, total + w]
        total, last = total + w, p
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= seg[2]:
                j -= 1
            if j < 0 or out[j][3] >= seg[3]:
                out.append(seg)
                break
            seg = [out[j][0], seg[1], out[j][2], seg[3]]
            del out[j:]
    return [(int(a), int(b), hi - lo) for a, b, lo, hi in out]


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    rest: float = -0.01
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    slope: float = 0.0
    bias: float = -math.inf

    def reader(self):
        """text -> (tokens, maximal segments); memo of bounded size."""
        weights, rest = self.weights, self.rest

        class Memo(dict):
            def __missing__(self, word: bytes) -> float:
                if len(self) > 200_000:
                    self.clear()
                w = weights.get(word)
                if w is None and (s := stem(word)) is not None:
                    w = weights.get(s)
                self[word] = out = w or 0.0
                return out

        weigh = Memo().__getitem__

        def read(text: str) -> tuple[int, list[tuple[int, int, float]]]:
            tokens = words(text)
            w = np.fromiter(map(weigh, tokens), np.float64, len(tokens))
            hit = np.flatnonzero(w)
            return len(tokens), maximal_segments(hit.tolist(), w[hit].tolist(), rest) if len(hit) else []

        return read

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        """Sum of -ln E over the significant segments (E < 1), 0 without any."""
        log_kn = self.log_k + math.log(max(n, 1))
        return sum(max(0.0, self.rate * s - log_kn) for _, _, s in segments)

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(min(700.0, max(-700.0, -(self.slope * evidence + self.bias)))))


def labelled(labels: DataFrame, usable: Column, most: int) -> DataFrame:
    """(doc_id, toxic) of about ``most`` usable labelled documents at most."""
    rows = labels.where(usable).where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = materialize(rows)
    share = min(1.0, most / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def one_of_copies(training: DataFrame) -> DataFrame:
    """(doc_id, toxic) of one document for each sequence of words (128-bit hash) and class,
    so a copied text is not many witnesses.  Documents that differ in a word all count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            doc, text, toxic = arrow_columns(b, "doc_id", "text", "toxic")
            same = [xxhash.xxh3_128_digest(b" ".join(words(t))) for t in each_text(text)]
            yield pa.record_batch([doc, toxic, pa.array(same, pa.binary())], names=["doc_id", "toxic", "same"])

    kind = training.schema["doc_id"].dataType.simpleString()
    return map_arrow(training, run, f"doc_id {kind}, toxic int, same binary").groupBy("same", "toxic").agg(
        F.min("doc_id").alias("doc_id")).select("doc_id", "toxic")


def count_tokens(training: DataFrame) -> DataFrame:
    """(token, toxic, clean): documents with the token, by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Counter] = [Counter(), Counter()]

        def rows() -> pa.RecordBatch:
            clean, toxic = seen
            tokens = list(clean.keys() | toxic.keys())
            out = pa.record_batch([pa.array(tokens, pa.binary()), pa.array([toxic[t] for t in tokens], pa.int64()),
                                   pa.array([clean[t] for t in tokens], pa.int64())], names=["token", "toxic", "clean"])
            seen[:] = Counter(), Counter()
            return out

        for b in batches:
            texts, classes = arrow_columns(b, "text", "toxic")
            for text, toxic in zip(each_text(texts), classes.to_pylist(), strict=True):
                found = set(words(text))
                found |= {s for w in found if (s := stem(w)) is not None}
                seen[toxic].update(found)
                if len(seen[0]) + len(seen[1]) > 400_000:
                    yield rows()
        yield rows()

    return map_arrow(training, run, "token binary, toxic long, clean long").groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def token_weights(counts: DataFrame, prior: float, least_z: float, least_odds: float) -> tuple[dict[bytes, float], list, float]:
    """Weights of the significant tokens, their (weight, clean share) and the rest's weight."""
    n = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    nt, nc = float(n.t or 0), float(n.c or 0)
    if not nt or not nc:
        return {}, [], -0.01
    share = (F.col("toxic") + F.col("clean")) / (nt + nc)
    t, c = F.col("toxic") + prior * share + 0.5, F.col("clean") + prior * share + 0.5
    odds = F.log(t / (nt + prior - t)) - F.log(c / (nc + prior - c))
    z = odds / F.sqrt(1 / t + 1 / c)
    best = (counts.where("toxic >= 3").select("token", "toxic", "clean", odds.alias("odds"), c.alias("c"), z.alias("z"))
            .where((F.col("z") >= least_z) & (F.col("odds") >= least_odds)).orderBy(F.desc("z"), "token").collect())
    weights = {bytes(r.token): r.odds for r in best}
    top = [(r.odds, r.c / (nc + prior)) for r in best]
    mass_t, mass_c = (sum(r[k] for r in best) / m for k, m in (("toxic", nt), ("clean", nc)))
    return weights, top, min(-1e-3, math.log(max(1 - mass_t, 1e-3) / max(1 - mass_c, 1e-3)))


def solve_rate(top: list[tuple[float, float]], rest: float) -> float:
    """The positive root of sum(p exp(rate * weight)) = 1 over the clean tokens."""
    mass = sum(p for _, p in top)
    f = lambda x: sum(p * math.exp(min(x * w, 600)) for w, p in top) + (1 - mass) * math.exp(x * rest) - 1
    lo, hi = 1e-3, 8.0
    if not top or f(hi) < 0 or f(lo) > 0:
        return 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def fit_curve(bins: list[tuple[float, int, int]], steps: int = 50) -> tuple[float, float]:
    """Logistic slope (not negative) and bias of (evidence, label, count) rows, by Newton steps."""
    x, y, n = (np.array(v, float) for v in zip(*bins, strict=True))
    a = b = 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(n * (y - p) * x).sum() - 0.01 * a, (n * (y - p)).sum() - 0.01 * b])
        v = n * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a + step[0], b + step[1]
    return max(0.0, float(a)), float(b)


def train(docs: DataFrame, labels: DataFrame, usable: Column, most_labelled: int = 200_000, prior: float = 10.0,
          least_z: float = 3.5, least_odds: float = 2.0) -> Model:
    chosen = labelled(labels, usable, most_labelled)
    # at most about ``most_labelled`` rows of two numbers: a proven bound
    docs = id_text(docs)
    chosen = materialize(one_of_copies(docs.join(F.broadcast(chosen), "doc_id")))
    training = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    weights, top, rest = token_weights(materialize(count_tokens(training)), prior, least_z, least_odds)
    if not weights:
        return Model()
    model = Model(weights, rest, solve_rate(top, rest))

    def best_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = model.reader()
        for b in batches:
            text, toxic = arrow_columns(b, "text", "toxic")
            got = [(n, max((s for _, _, s in segs), default=0.0), len(segs)) for n, segs in map(read, each_text(text))]
            yield pa.record_batch([toxic, *(pa.array([g[i] for g in got], t) for i, t in enumerate((pa.int64(), pa.float64(), pa.int64())))],
                                  names=["toxic", "n", "best", "segments"])

    seen = materialize(map_arrow(training, best_segments, "toxic int, n long, best double, segments long"))
    clean = seen.where("toxic = 0 and n > 0").agg(F.avg(model.rate * F.col("best") - F.log("n")).alias("m")).first()
    model.log_k = (clean.m or 0.0) - 0.5772156649
    evidence = F.greatest(F.lit(0.0), model.rate * F.col("best") - model.log_k - F.log(F.greatest("n", F.lit(1))))
    bins = seen.groupBy("toxic", F.least(F.floor(4 * evidence), F.lit(400)).alias("bin")).count().collect()  # 802 rows at most
    if len({r.toxic for r in bins}) == 2:
        model.slope, model.bias = fit_curve([((r.bin + 0.5 * (r.bin > 0)) / 4, r.toxic, r["count"]) for r in bins])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, passages): ``passages`` are the significant segments, as first and
    last word and score."""
    docs = id_text(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = model.reader()
        for b in batches:
            doc, text = arrow_columns(b, "doc_id", "text")
            scores, passages = [], []
            for n, segs in map(read, each_text(text)):
                scores.append(model.score(model.evidence(n, segs)))
                limit = model.log_k + math.log(max(n, 1))
                passages.append([{"first": a, "last": z, "score": s} for a, z, s in segs if model.rate * s > limit])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
            yield pa.record_batch([doc, pa.array(scores, pa.float64()), pa.array(passages, kind)], names=["doc_id", "score", "passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs, run, f"doc_id {kind}, score double, passages array<struct<first:long,last:long,score:double>>")


def drop_toxic(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = model.reader()
        for b in batches:
            texts = each_text(arrow_columns(b, "text")[0])
            yield b.filter(pa.array([model.score(model.evidence(*read(t or ""))) < least for t in texts], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
