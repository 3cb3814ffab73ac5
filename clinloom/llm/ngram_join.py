"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set has its distinct ``width``-word shingles as 64-bit hashes.  Documents
with equal sets form a class (a 64-bit hash of the sorted set); all further work is on
one member of each class.

*Prefixes.*  Shingles are ordered by a frequency estimate, rare ones first (a count sketch
of fixed size over all documents), ties by hash.  Two sets with at least t shingles in
common share at least l among the first n - t + l of each.  A set chooses its l: a longer
prefix holds more and commoner shingles, but only partners that share l of them remain, so
it takes the l of least estimated cost (postings read plus candidates to verify).  A pair
is a candidate if its prefixes share min(l, l') shingles, and if what lies behind the
first shared positions can still reach the threshold.  Candidates are verified on their
whole sets.

*Groups of copies.*  Only components are asked for, so pairs whose members are connected
already need no look.  Before all remaining candidates are listed, classes are compared
with few others: first with the smallest class of a prefix shingle's list, then, in two
rounds, with members of the list's largest component.  Large groups collapse in these
rounds, and the last, complete round lists only pairs between different components, never pairs inside
the largest component of a list.  No link between components is lost.

*Skew.*  A shingle whose estimate is small has a list no longer than that (the sketch never
counts too low); these lists are looked through one by one in sorted partitions.  Longer
lists are never gathered: they are handled by aggregates with map-side combination and
joins of written tables, which Spark can split.  Before whole sets are moved for a pair, its
sets' outlines (counts by 256 hash ranges) must allow the threshold.

Defined results: a null or empty text, or one without words, has an empty set and is
its own component; repeated rows are copies; a row with a null doc_id has a null
component and links nothing; other columns are ignored; an empty table gives an empty one.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import arrow_columns, each_text, id_text, map_arrow, table
from clinloom.llm.graph import IdFilter, joined_components
from clinloom.session import materialize

WIDTH, PERCENT, MOST_MATCHES = 5, 80, 4
SKETCH_BITS, CHUNK_BITS = 20, 14
LONG_LIST = 1024  # lists of more postings by estimate are not gathered
# position of the parts of a posting's packed long: set size, position, matches asked for
N_SHIFT, POS_SHIFT, POS_MASK = 36, 8, (1 << 28) - 1


class Shingles:
    """Sorted distinct shingle hashes of texts; memo of word hashes of bounded size."""

    _MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0x85EBCA77C2B2AE63)]

    def __init__(self, width: int):
        import xxhash

        class Hashes(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) > 200_000:
                    self.clear()
                self[word] = h = xxhash.xxh64_intdigest(word)
                return h

        self.width, self.of_word = width, Hashes().__getitem__
        self.digest = xxhash.xxh3_64_intdigest

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()  # bytes: A-Z only, and exactly \x20 and \x09-\x0D
        h = np.fromiter(map(self.of_word, words), np.uint64, len(words))
        k = min(self.width, len(h))
        if not k:
            return h
        m = len(h) - k + 1
        out = np.full(m, k, np.uint64)
        for i in range(k):
            out = (out ^ h[i:i + m]) * self._MIX[i % 5]
            out ^= out >> np.uint64(29)
        out.sort()
        keep = np.empty(m, bool)
        keep[0] = True
        np.not_equal(out[1:], out[:-1], out=keep[1:])
        return out[keep]

    def class_of(self, shingles: np.ndarray) -> int:
        """Hash of the set, as a signed long."""
        return int(np.uint64(self.digest(shingles.tobytes())).astype(np.int64))


def sets_and_sketch(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, cls, outline) of every row, and the count sketch of all shingles.  The
    outline counts a set's shingles by their highest byte (empty if a count exceeds a byte)."""
    chunk = 1 << CHUNK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        sets, counts = Shingles(width), np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc_id", "n", "cls", "outline", "chunk", "counts"]
        doc_type = pa.int64()
        for b in batches:
            doc, text = arrow_columns(b, "doc_id", "text")
            doc_type, n, cls, outlines = doc.type, [], [], []
            for t in each_text(text):
                s = sets(t)
                n.append(len(s))
                high = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256)
                outlines.append(high.astype(np.uint8).tobytes() if high.max() < 256 else b"")
                cls.append(sets.class_of(s) if len(s) else None)
                np.add.at(counts, s >> np.uint64(64 - SKETCH_BITS), 1)
            rows = len(n)
            yield pa.record_batch([doc, pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(outlines, pa.binary()),
                                   pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
        if counts.any():
            parts = counts.reshape(-1, chunk)
            k = len(parts)
            packed = [zstandard.compress(p.tobytes(), 1) for p in parts]
            yield pa.record_batch([pa.nulls(k, doc_type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
                                   pa.array(range(k), pa.int32()), pa.array(packed, pa.binary())], names=names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        total: dict[int, np.ndarray] = {}
        for b in batches:
            for c, packed in zip(*(x.to_pylist() for x in b.columns), strict=True):
                counts = np.frombuffer(zstandard.decompress(packed, max_output_size=8 * chunk), np.int64)
                total[c] = total[c] + counts if c in total else counts
        yield pa.record_batch([pa.array(total.keys(), pa.int32()), pa.array([zstandard.compress(v.tobytes(), 1) for v in total.values()], pa.binary())],
                              names=["chunk", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = materialize(map_arrow(docs, run, f"doc_id {kind}, n long, cls long, outline binary, chunk int, counts binary"))
    parts = map_arrow(rows.where("chunk is not null").select("chunk", "counts"), add, "chunk int, counts binary")
    parts = map_arrow(parts.repartition("chunk"), add, "chunk int, counts binary").collect()  # 64 rows, 8 MB unpacked
    import zstandard

    sketch = np.zeros((1 << (SKETCH_BITS - CHUNK_BITS), chunk), np.int64)
    for r in parts:
        sketch[r.chunk] += np.frombuffer(zstandard.decompress(bytes(r.counts), max_output_size=8 * chunk), np.int64)
    return rows.where("chunk is null").select("doc_id", "n", "cls", "outline"), np.minimum(sketch.reshape(-1), (1 << 31) - 1).astype(np.uint32)


def prefix(shingles: np.ndarray, estimate: np.ndarray, noise: float, percent: int, most: int) -> tuple[np.ndarray, int]:
    """Order of the prefix shingles (indices, rare ones first) and the matches asked for."""
    n = len(shingles)
    t = (percent * n + 99) // 100
    most = min(most, t)
    longest = n - t + most
    if longest < n:  # the cheapest way to the first ``longest`` in order of (estimate, hash)
        first = np.flatnonzero(estimate <= np.partition(estimate, longest - 1)[longest - 1])
    else:
        first = np.arange(n)
    order = first[np.argsort(estimate[first], kind="stable")][:longest]
    listed = np.cumsum(np.maximum(estimate[order] - noise, 0.0))
    asked = np.arange(1, most + 1)
    upto = listed[n - t + asked - 1]
    best = int(np.argmin(upto * (1 + n / (20.0 * asked)) + asked)) + 1
    return order[:n - t + best], best


def postings(docs: DataFrame, sketch: np.ndarray, width: int, percent: int, most: int) -> DataFrame:
    """(token, cls, meta, long_list) of every prefix shingle."""
    noise = float(np.median(sketch))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingles(width)
        for b in batches:
            token, cls, meta, long_list = [], [], [], []

            def rows() -> pa.RecordBatch:
                out = pa.record_batch([pa.array(np.concatenate(token).view(np.int64)), pa.array(np.concatenate(cls)), pa.array(np.concatenate(meta)),
                                       pa.array(np.concatenate(long_list))], names=["token", "cls", "meta", "long_list"])
                for x in (token, cls, meta, long_list):
                    x.clear()
                return out

            size = 0
            for text in each_text(arrow_columns(b, "text")[0]):
                s = sets(text)
                if not len(s):
                    continue
                estimate = sketch[s >> np.uint64(64 - SKETCH_BITS)].astype(np.int64)
                order, asked = prefix(s, estimate, noise, percent, most)
                token.append(s[order])
                cls.append(np.full(len(order), sets.class_of(s)))
                meta.append((len(s) << N_SHIFT) | (np.arange(len(order)) << POS_SHIFT) | asked)
                long_list.append(estimate[order] > LONG_LIST)
                size += len(order)
                if size > 200_000:
                    yield rows()
                    size = 0
            if token:
                yield rows()

    return map_arrow(docs, run, "token long, cls long, meta long, long_list boolean")


def shared(posted: DataFrame) -> DataFrame:
    """The postings of tokens that more than one class may have, once each: token, cls,
    n, pos, asked.  Long lists are spread by class and kept without a look at them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams sorted lists; a list that a batch ends in waits for the next one, but
        a long list, which is not looked at, goes on at once."""
        tail = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if tail is not None:
                cols = [np.concatenate(x) for x in zip(tail, cols, strict=True)]
            cut = len(cols[0]) - 1 if cols[3][-1] else int(np.searchsorted(cols[0], cols[0][-1]))
            tail = [c[cut:] for c in cols]
            if cut:
                yield from listed([c[:cut] for c in cols])
        if tail is not None:
            yield from listed(tail)

    def listed(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, cls = cols[0], cols[1]
        new = np.ones(len(token), bool)  # rows are sorted by token and class: copies go
        new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
        token, cls, meta, long_list = (c[new] for c in cols)
        same = token[1:] == token[:-1]
        keep = long_list.copy()
        keep[1:] |= same
        keep[:-1] |= same
        if keep.any():
            yield pa.record_batch([pa.array(c[keep]) for c in (token, cls, meta)], names=["token", "cls", "meta"])

    spread = F.when(F.col("long_list"), F.pmod(F.col("cls"), F.lit(256))).otherwise(0)
    dealt = posted.repartition("token", spread).sortWithinPartitions("token", "cls")
    return map_arrow(dealt, run, "token long, cls long, meta long").select(
        "token", "cls", F.shiftright("meta", N_SHIFT).alias("n"),
        F.shiftright("meta", POS_SHIFT).bitwiseAND(F.lit(POS_MASK)).alias("pos"), F.col("meta").bitwiseAND(F.lit(255)).alias("asked"))


class Verifier:
    """Verifies candidate pairs of classes on their whole sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int, percent: int):
        self.docs, self.classes, self.width, self.percent = docs, classes, width, percent

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(cls, shingles) of the classes ``wanted``, from the texts of their members."""
        wanted = materialize(wanted.join(self.classes.select("cls", "rep"), "cls"))
        near, width = IdFilter(wanted, "rep"), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets = Shingles(width)
            for b in batches:
                h, text = arrow_columns(b, "h", "text")
                passed = text.filter(pa.array(near.passes(h.to_numpy())))
                found = [s for t in each_text(passed) if len(s := sets(t))]
                if found:
                    ends = np.cumsum([0, *map(len, found)])
                    yield pa.record_batch([pa.array(map(sets.class_of, found), pa.int64()), pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(np.concatenate(found).view(np.int64)))], names=["cls", "shingles"])

        texts = self.docs.where("doc_id is not null").select(F.xxhash64("doc_id").alias("h"), "text")
        made = map_arrow(texts, run, "cls long, shingles array<long>")
        return made.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose outlines allow the threshold: the sum of the smaller counts is
        never less than what the sets share."""
        percent, kept = self.percent, pairs.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                oa, ob, na, nb = (b.column(b.schema.get_field_index(c)) for c in ("oa", "ob", "na", "nb"))
                most = np.minimum(na.to_numpy(), nb.to_numpy())
                both = np.array([bool(x) and bool(y) for x, y in zip(oa.to_pylist(), ob.to_pylist(), strict=True)], bool)
                if both.any():
                    x, y = (np.frombuffer(b"".join(o.filter(pa.array(both)).to_pylist()), np.uint8).reshape(-1, 256) for o in (oa, ob))
                    most[both] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                fits = (100 + percent) * most >= percent * (na.to_numpy() + nb.to_numpy())
                yield b.filter(pa.array(fits)).select(kept)

        of = lambda x: self.classes.select(F.col("cls").alias(x), F.col("outline").alias(f"o{x}"), F.col("n").alias(f"n{x}"))
        return map_arrow(pairs.join(of("a"), "a").join(of("b"), "b"), run, pairs.schema)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The (written) pairs (a, b) whose sets are similar enough."""
        pairs = materialize(self.possible(pairs))
        sets = materialize(self.sets(pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()))
        left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
        right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - both
        return materialize(pairs.join(left, "a").join(right, "b").where(100 * both >= self.percent * union).select("a", "b"))


def _fits(a: str, b: str, percent: int):
    """Set sizes that allow the threshold."""
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The postings with each class's component, of the tokens that meet two of them."""
    if labels is None:
        return lists.withColumn("comp", F.col("cls"))
    named = lists.drop("comp").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    named = materialize(named)
    open_lists = materialize(named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token"))
    return materialize(named.join(open_lists, "token"))


def first_partners(lists: DataFrame, percent: int) -> DataFrame:
    """Each class with one other: the smallest class of a list, met in most lists."""
    smallest = lists.groupBy("token").agg(F.min(F.struct(F.col("cls").alias("b"), F.col("n").alias("nb"))).alias("x"))
    return _most_met(lists.join(materialize(smallest.select("token", "x.b", "x.nb")), "token").where("cls <> b"), percent, 1, 0)


def further_partners(lists: DataFrame, percent: int, tried: DataFrame, found: DataFrame, seed: int, partners: int) -> DataFrame:
    """Each class outside the largest component of a list with members of that component:
    in each list the one of the highest share of links among the pairs tried so far (one
    near the middle of its group), and by a hash where little was tried."""
    times = lambda pairs, name: pairs.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias(name))
    share = materialize(times(tried, "tried").join(times(found, "found"), "cls", "left").select(
        "cls", (F.coalesce("found", F.lit(0)) / (F.col("tried") + 2)).alias("share")))
    luck = F.pmod(F.xxhash64("cls", "token", F.lit(seed)), F.lit(1024)) / 4096
    lists = materialize(lists.join(share, "cls", "left").withColumn("rank", F.coalesce("share", F.lit(0.0)) + luck).drop("share"))
    of_comp = lists.groupBy("token", "comp").agg(F.count("*").alias("size"), F.max(F.struct("rank", F.col("cls").alias("b"), F.col("n").alias("nb"))).alias("m"))
    largest = of_comp.groupBy("token").agg(F.max(F.struct("size", F.col("comp").alias("largest"), "m")).alias("x"))
    met = lists.join(materialize(largest.select("token", "x.largest", "x.m.b", "x.m.nb")), "token").where("comp <> largest")
    return _most_met(met, percent, partners, seed)


def _most_met(met: DataFrame, percent: int, partners: int, seed: int) -> DataFrame:
    met = met.where(_fits("n", "nb", percent)).groupBy(F.col("cls").alias("a"), "b").agg(F.count("*").alias("met"))
    best = met.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("met", F.xxhash64("b", F.lit(seed)), "b")), asc=False).alias("s"))
    return best.select("a", F.explode(F.slice("s", 1, partners)).alias("p")).select("a", "p.b")


def meetings(lists: DataFrame, percent: int) -> DataFrame:
    """The postings of different components that meet in a list and may be a linked pair's first.

    All that a linked pair has in common is its first common token, in the tokens' order, or lies
    behind it in both sets, and that token is in both prefixes.  So only tokens whose positions
    allow the threshold without any common one before them bring a pair up."""
    lists = lists.where(100 * (F.col("n") - F.col("pos")) >= percent * F.col("n"))  # a partner has at least what is common
    size = lists.groupBy("token", "comp").agg(F.count("*").alias("size"))
    base = materialize(size.groupBy("token").agg(F.max_by("comp", F.struct("size", "comp")).alias("base")))
    lists = materialize(lists.join(base, "token").withColumn("in_base", F.col("comp") == F.col("base")).drop("base"))
    a = lists.where("not in_base").select("token", *(F.col(c).alias(f"{c}_a") for c in ("cls", "comp", "n", "pos", "asked")))
    b = lists.select("token", "in_base", *(F.col(c).alias(f"{c}_b") for c in ("cls", "comp", "n", "pos", "asked")))
    met = a.join(b, "token").where((F.col("comp_a") != F.col("comp_b")) & (F.col("in_base") | (F.col("cls_a") < F.col("cls_b"))))
    behind = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    return met.where(_fits("n_a", "n_b", percent) & ((100 + percent) * behind >= percent * (F.col("n_a") + F.col("n_b"))))


def remaining(lists: DataFrame, percent: int, verify: Verifier | None = None) -> DataFrame:
    """All candidates between components that are left.  A pair's matches are counted in its two
    prefixes once it has met and (with ``verify``) its outlines allow a link, so common tokens behind
    the first ones make no rows, and no prefix is moved for pairs that only lie near each other."""
    # a pair may meet as (outside, base) in one list and as (base, outside) in another
    pairs = materialize(meetings(lists, percent).groupBy(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).agg(
        F.first(F.least("asked_a", "asked_b")).alias("asked")))
    if verify is not None:
        pairs = materialize(verify.possible(pairs))
    in_pairs = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    prefixes = materialize(lists.join(in_pairs, "cls", "left_semi").groupBy("cls").agg(F.collect_list("token").alias("tokens")))
    of = lambda x: prefixes.select(F.col("cls").alias(x), F.col("tokens").alias(f"t{x}"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(both >= F.col("asked")).select("a", "b")


def classes_and_rows(docs: DataFrame, width: int, percent: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The classes (cls, rep, n, component), named by their smallest doc_ids, and
    (doc_id, n, cls) of every row of ``docs`` (doc_id, text)."""
    sets, sketch = sets_and_sketch(docs, width)
    classes = materialize(sets.where("doc_id is not null and cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("outline").alias("outline")))
    lists = materialize(shared(postings(docs.where("doc_id is not null"), sketch, width, percent, most)))
    verify = Verifier(docs, classes, width, percent)
    tried = links = labels = None
    for step in range(4):
        lists = labelled(lists, labels)
        pairs = materialize(first_partners(lists, percent) if step == 0 else remaining(lists, percent, verify) if step == 3
                            else further_partners(lists, percent, tried, links, step, 8))
        found = verify.links(pairs)
        tried, links = (pairs, found) if step == 0 else (tried.union(pairs), materialize(links.union(found)))
        labels = joined_components(labels, found)
    named = materialize(classes.drop("outline").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls")))
    least = materialize(named.groupBy("comp").agg(F.min("rep").alias("component")))
    return materialize(named.join(least, "comp").drop("comp")), sets.drop("outline")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, most: int = MOST_MATCHES) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id of every document: the component of the
    links 100 * |A & B| >= percent * |A | B| and the class of equal sets, each named by
    its smallest doc_id."""
    classes, rows = classes_and_rows(id_text(docs), width, percent, most)
    own = F.col("doc_id").isNotNull()
    return rows.join(classes.select("cls", "rep", "component"), "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(own, F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(own, F.coalesce("rep", "doc_id")).alias("class_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of each component the
    document of the smallest doc_id, of repeated doc_ids one row (the smallest in column
    order); rows with a null doc_id stay."""
    found = materialize(jaccard_components(docs).where("doc_id is not null"))
    gone = materialize(found.where("doc_id <> component_id").select("doc_id").distinct())
    again = materialize(found.groupBy("doc_id").agg(F.count("*").alias("times")).where("times > 1").select("doc_id"))
    stay = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    twice = stay.join(again, "doc_id", "left_semi").select(docs.columns)
    once = twice.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*")
    return stay.join(again, "doc_id", "left_anti").select(docs.columns).union(once.select(docs.columns))


def op1_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
