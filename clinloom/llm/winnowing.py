"""Benchmark decontamination by winnowing, native only.

Both sides are cut into words, and each run of ``SIZE`` words (a k-gram) is hashed.  Of every
``SPAN - SIZE + 1`` neighbouring k-grams the one of minimum hash is kept (all, where equal
ones tie).  Two texts that share ``SPAN`` words have that whole window of k-grams in common,
so they keep the same one at the same place: no shared span of that length is lost.  Documents and
items are joined on kept k-grams, and each hit is extended word by word to both sides, at most
as far as a window that holds the k-gram can reach; a stretch of ``SPAN`` equal words is a hit.

An item of fewer words is one window.  From ``SIZE`` words on it is sought by its k-gram of
minimum hash among all k-grams of a document, below that by its whole sequence; both are
extended and compared like the others.

Only k-grams that a bitmap of the items' k-grams lets pass leave a document (the bitmap has 16
bits an item k-gram, 1 MB at most; beyond that it thins less, and the join decides as before),
together with the words around them.  The texts are read once.  Item k-grams with equal
surroundings form a class, so that documents meet classes and not items; Spark broadcasts the
written item tables if their files are small and else splits a hot key's join.

Defined results: a null text has no words; an item without words has no window; an item with
a null item_id hits but is not listed, and rows that repeat an item_id are one item; repeated
documents give equal rows; a null doc_id stays null; other columns are ignored; without items
nothing is hit; an empty document table gives an empty one.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import id_text, table
from clinloom.session import materialize

SIZE, SPAN = 5, 10
WINDOW, BEYOND = SPAN - SIZE + 1, SPAN - SIZE
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MOST_BITS, ROW_BITS = 1 << 23, 1 << 15
ANCHOR = "array<struct<size:int,key:bigint,pos:int,around:array<string>>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once a row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def grams(hashes: Column, size: int) -> Column:
    """The hash of the ``size`` words from each word on that has so many."""
    first = F.slice(hashes, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))
    return F.transform(first, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, size))))


def minima(keys: Column) -> Column:
    """The least key of each window of neighbouring k-grams."""
    first = F.slice(keys, 1, F.greatest(F.size(keys) - (WINDOW - 1), F.lit(0)))
    return F.transform(first, lambda k, i: F.least(k, *(F.get(keys, i + j) for j in range(1, WINDOW))))


def is_kept(gram: Column, least: Column) -> Column:
    """Whether a k-gram (key, pos) is the least of a window that holds it."""
    return gram["key"] == F.greatest(*(F.get(least, gram["pos"] - j) for j in range(WINDOW)))


def placed(keys: Column) -> Column:
    return F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("pos")))


def anchors(words: Column, size: int, chosen: Callable[[Column, Column], Column]) -> Column:
    """ANCHOR of the k-grams that ``chosen`` takes from (placed k-grams, window minima), with
    the words around: BEYOND before, the k-gram's own and BEYOND after it (null: none)."""
    def around(gram: Column) -> Column:
        near = F.transform(F.sequence(F.lit(-BEYOND), F.lit(SPAN - 1)), lambda d: F.get(words, gram["pos"] + d))
        return F.struct(F.lit(size).alias("size"), gram["key"].alias("key"), gram["pos"].alias("pos"), near.alias("around"))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashed, lambda h: let(grams(h, size), lambda k: let(minima(k), lambda m: F.transform(chosen(placed(k), m), around))))


class KeyFilter:
    """A bitmap of keys, as a constant of the query: no key of the set is missed."""

    def __init__(self, keys: DataFrame):
        n = keys.count()
        self.bits = ROW_BITS
        while self.bits < min(16 * n, MOST_BITS):
            self.bits *= 2
        at = F.pmod("key", F.lit(self.bits))
        rows = keys.select(at.alias("at")).groupBy((F.col("at") / ROW_BITS).cast("int").alias("row")).agg(
            F.bitmap_construct_agg(F.col("at") % ROW_BITS).alias("bits")).collect()  # 256 rows of 4 KB at most
        held = bytearray(self.bits // 8)
        for r in rows:
            held[r.row * ROW_BITS // 8:(r.row + 1) * ROW_BITS // 8] = r.bits
        longs = (int.from_bytes(held[i:i + 8], "little", signed=True) for i in range(0, len(held), 8))
        self.longs = F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")

    def passes(self, longs: Column, key: Column) -> Column:
        at = F.pmod(key, F.lit(self.bits))
        return F.getbit(F.get(longs, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1


def item_anchors(items: DataFrame) -> DataFrame:
    """(item_id, whole, need, size, key, around) of every item: ``whole`` where the k-gram was
    not chosen by winnowing, ``need`` words that a hit must have."""
    text = F.coalesce("text", F.lit(""))
    rows = items.select("item_id", words_of(text).alias("words")).withColumn("n", F.size("words"))
    rows = materialize(rows.where("n > 0"))
    words = F.col("words")
    least = lambda g, m: F.array(F.array_min(g))
    own = F.when(F.col("n") >= SPAN, anchors(words, SIZE, lambda g, m: F.filter(g, lambda x: is_kept(x, m))))
    own = own.when(F.col("n") >= SIZE, anchors(words, SIZE, least))
    for size in range(1, SIZE):
        own = own.when(F.col("n") == size, anchors(words, size, least))
    found = rows.select("item_id", (F.col("n") < SPAN).alias("whole"), F.least("n", F.lit(SPAN)).alias("need"), F.explode(own).alias("a"))
    return found.select("item_id", "whole", "need", "a.size", "a.key", "a.around")


def document_anchors(words: Column, sought: DataFrame) -> Column:
    """ANCHOR of a document's k-grams that may be an item's."""
    kinds = {(r.size, r.whole) for r in sought.select("size", "whole").distinct().collect()}  # 6 at most
    filters = {k: KeyFilter(sought.where((F.col("size") == k[0]) & (F.col("whole") == k[1])).select("key").distinct()) for k in sorted(kinds)}
    parts = []
    for size in sorted({s for s, _ in kinds}):
        winnowed, every = filters.get((size, False)), filters.get((size, True))

        def chosen(g: Column, m: Column, winnowed=winnowed, every=every) -> Column:
            bits = F.array(*(f.longs for f in (winnowed, every) if f))

            def take(b: Column, x: Column) -> Column:
                kept = [f.passes(b[i], x["key"]) & (is_kept(x, m) if f is winnowed else F.lit(True))
                        for i, f in enumerate(f for f in (winnowed, every) if f)]
                return kept[0] | kept[1] if len(kept) > 1 else kept[0]

            return let(bits, lambda b: F.filter(g, lambda x: take(b, x)))

        parts.append(anchors(words, size, chosen))
    return F.concat(*parts) if parts else F.array().cast(ANCHOR)


def extended(found: DataFrame) -> DataFrame:
    """``found`` with the hit [start, end) of a document's k-gram and an item's: the equal words
    around them.  Rows that are not long enough go."""
    same = lambda j: F.coalesce(F.get("around", F.lit(j)) == F.get("item_around", F.lit(j)), F.lit(False))

    def reach(at: list[int]) -> Column:
        out = F.lit(len(at))
        for n in range(len(at) - 1, -1, -1):
            out = F.when(~same(at[n]), n).otherwise(out)
        return out

    own = F.forall(F.sequence(F.lit(BEYOND), F.col("size") + (BEYOND - 1)), lambda j: F.get("around", j) == F.get("item_around", j))
    left, right = reach(list(range(BEYOND - 1, -1, -1))), reach(list(range(SPAN, SPAN + BEYOND)))
    spans = found.where(own).withColumn("start", F.col("pos") - left).withColumn("end", F.col("pos") + F.col("size") + right)
    return spans.where(F.col("end") - F.col("start") >= F.col("need"))


def union_of(spans: Column) -> Column:
    """Sorted spans with those that meet made one."""
    span = "array<struct<start:int,end:int>>"

    def add(out: Column, s: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        joined = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(out) > 0) & (s["start"] <= last["end"]), joined).otherwise(F.concat(out, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(span), add)


def covered(spans: Column) -> Column:
    """How many positions the spans cover."""
    def add(state: Column, s: Column) -> Column:
        more = F.greatest(s["end"] - F.greatest(s["start"], state["upto"]), F.lit(0))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["upto"], s["end"]).alias("upto"))

    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")), add, lambda s: s["n"].cast("long"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, spans (of hit words, as found) and items (ids as
    sorted strings) of every document."""
    sought = materialize(item_anchors(items))
    surroundings = [F.col(c) for c in ("size", "key", "need", "around")]
    named = materialize(sought.withColumn("class", F.xxhash64(*surroundings)).select("item_id", "class", *surroundings))
    classes = materialize(named.groupBy("class").agg(*(F.first(c).alias("item_around" if c == "around" else c) for c in ("size", "key", "need", "around"))))
    of_class = materialize(named.where("item_id is not null").select("class", F.col("item_id").cast("string").alias("item")).distinct())

    scanned = id_text(docs).withColumn("text_hash", F.xxhash64("text"))
    made = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), document_anchors(w, sought).alias("anchors")))
    scanned = materialize(scanned.select("doc_id", "text_hash", made.alias("made")).select("doc_id", "text_hash", "made.*"))

    asked = scanned.where("size(anchors) > 0").select("doc_id", "text_hash", F.explode("anchors").alias("a")).select("doc_id", "text_hash", "a.*")
    hits = materialize(extended(asked.join(classes, ["size", "key"])).select("doc_id", "text_hash", "class", "start", "end").distinct())
    key = ["doc_id", "text_hash"]
    spans = hits.groupBy(key).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    listed = hits.select(*key, "class").distinct().join(of_class, "class").groupBy(key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    found = materialize(spans.join(listed, same(spans, listed), "left").select(*(spans[c] for c in (*key, "spans")), "items"))
    none = F.array().cast("array<string>")
    out = scanned.join(found, same(scanned, found), "left").select(
        scanned["doc_id"], scanned["text_hash"], "n_words", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", none).alias("items"))
    return out.select("doc_id", "text_hash", "n_words", covered(F.col("spans")).alias("n_hit"), "spans", "items")


def op13_winnowing(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
