"""Personal data: base patterns and bootstrapped contextual extraction, native only.

Seeds are the matches of the base patterns.  Each seed induces lexical patterns from its
context: the word before it, the two words before it and the word after it, each with the mark that
closes it (``mail me at``, ``id:``, ``is``).  The other instances are tokens that look like an identifier
(four digits or more, or ``@``) and are no seeds; with the patterns around them they make the
edges of a graph between patterns and instances.

A pattern is scored against all its occurrences in the corpus: its confidence is the sum of its
distinct instances' scores over their number, plus the occurrences without an instance,
plus one.  A seed scores 1; another instance scores 1 - prod(1 - confidence) over its
patterns, from 0 on.  Scores only grow, and rounds go on until none grows by more than ``settled``.
Patterns of high confidence, held up by several instances, mark the unseen identifiers beside
them as spans of kind ``id``; ``report`` says how many of each the graph holds.  In a corpus whose
seeds stand beside arbitrary words no pattern is trusted, and none is added.

The context of a span is sought in CONTEXT characters before and behind it; words and
values may be of any length, and the graph knows a value by its SHA-256.  The texts are read twice: for
spans and contexts, and to count the induced patterns' occurrences (a bitmap of the patterns lets
few other words leave a document).  All counts are aggregates with map-side combination over
distinct edges, so a common word or value does not gather in one task; no Python runs on the
executors.

Defined results: a null text counts as empty; repeated rows give equal results; a null
doc_id stays null; other columns are ignored; an empty table gives an empty one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import id_text, table
from clinloom.llm.text_spans import SPAN, count_kind, find_spans, masked, written
from clinloom.llm.winnowing import KeyFilter, let
from clinloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"

# Possessive forms of the base patterns.  What follows each run never begins with a
# character of the run, so giving characters back could not make a match; the look-behinds
# only skip starts inside a run whose first start has failed for the same reason.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"  # shorter chains fail the length test anyway
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
UNIT = r"\p{L}[\p{L}\p{N}_'-]*+(?:\x20?[^\p{L}\p{N}\s])?"  # a word and the mark that closes it
CHARS = "A-Za-z0-9@._%+()/-"
TOKEN = rf"(?<![{CHARS}])[A-Za-z._%+()/-]*+[0-9@][{CHARS}]{{2,}}+"
CONTEXT = 400
PATTERN = "array<struct<side:string,pattern:string,key:bigint>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    digit = text.rlike("[0-9]")
    card = lambda v: F.length(_digits(v)).between(16, 19) & F.call_function("luhn_check", _digits(v))
    return F.concat(
        find_spans(text, "email", 0, EMAIL, F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        find_spans(text, "ip", 1, IP, text.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        find_spans(text, "card", 2, CARD, digit, card),
        find_spans(text, "phone", 3, PHONE, text.rlike(r"\+[0-9]"), lambda v: F.length(_digits(v)).between(8, 15)))


def units(text: Column) -> Column:
    """The words of a text in lower case with their closing marks, without blanks inside."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(UNIT), F.lit(0)), lambda u: F.replace(u, F.lit(" "), F.lit("")))


def contexts(text: Column, start: Column, end: Column) -> Column:
    """The patterns that a span at [start, end) has around it (PATTERN)."""
    from_ = F.greatest(start - CONTEXT, F.lit(0))
    left, right = F.substring(text, from_ + 1, start - from_), F.substring(text, end + 1, F.lit(CONTEXT))

    def patterns(u: Column) -> Column:
        before = u["before"]
        one, two = F.get(before, F.size(before) - 1), F.get(before, F.size(before) - 2)
        after = F.get(u["after"], F.lit(0))
        made = F.array(
            F.when(u["near"] & one.isNotNull(), F.struct(F.lit("before").alias("side"), one.alias("pattern"), F.xxhash64(one).alias("key"))),
            F.when(u["near"] & two.isNotNull(), F.struct(F.lit("two before").alias("side"), F.concat_ws(" ", two, one).alias("pattern"),
                                                         F.xxhash64(two, one).alias("key"))),
            F.when(u["next"] & after.isNotNull(), F.struct(F.lit("after").alias("side"), after.alias("pattern"), F.xxhash64(after).alias("key"))))
        return F.filter(made, lambda x: x.isNotNull())

    around = F.struct(units(left).alias("before"), left.rlike(UNIT + r"[\s\"']{0,3}$").alias("near"),
                      units(right).alias("after"), right.rlike(r"^[^\p{L}\p{N}]{0,4}" + UNIT).alias("next"))
    return let(around, patterns)


def instances(text: Column, base: Column) -> Column:
    """array<struct<patterns, value, start, end, seed, open>> of every seed and every other
    token that looks like an identifier."""
    def trimmed(s: Column) -> Column:
        value = F.regexp_replace(F.regexp_replace(s["value"], "^[^A-Za-z0-9+(]+", ""), "[^A-Za-z0-9]+$", "")
        end = s["end"] - F.length(F.regexp_extract(s["value"], "([^A-Za-z0-9]*)$", 1))
        return F.struct(value.alias("value"), (end - F.length(value)).alias("start"), end.alias("end"))

    like = lambda v: (F.length(_digits(v)) >= 4) | F.contains(v, F.lit("@"))
    found = F.transform(find_spans(text, FOUND, len(KINDS), TOKEN, text.rlike("[0-9@]"), like), trimmed)
    other = F.filter(found, lambda s: (s["end"] > s["start"]) & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    seeds = F.transform(base, lambda b: F.struct(b["value"].alias("value"), b["start"].alias("start"), b["end"].alias("end")))

    def cue(seed: bool):
        return lambda s: F.struct(contexts(text, s["start"], s["end"]).alias("patterns"), F.lower(s["value"]).alias("value"), s["start"].alias("start"),
                                  s["end"].alias("end"), F.lit(seed).alias("seed"), F.lit(not seed).alias("open"))

    return F.concat(F.transform(seeds, cue(True)), F.transform(other, cue(False)))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, cues) of every row, from one pass over the texts."""
    text = F.col("text")
    rows = id_text(docs).withColumn("base", base_spans(text))
    return rows.select("doc_id", F.xxhash64(text).alias("text_hash"), "base", instances(text, F.col("base")).alias("cues"))


def occurrences(docs: DataFrame, induced: DataFrame) -> DataFrame:
    """(key, n): how often the words of the ``induced`` patterns (distinct keys) stand in the corpus.
    An inner join on purpose: Spark moves a semi join below the aggregate, and there it would
    shuffle every single occurrence instead of each task's counts."""
    near = KeyFilter(induced)

    def keys(u: Column) -> Column:
        single = F.transform(u, lambda x: F.xxhash64(x))
        double = F.transform(F.slice(u, 2, F.greatest(F.size(u) - 1, F.lit(0))), lambda x, i: F.xxhash64(F.get(u, i), x))
        return let(F.array(near.longs), lambda b: F.filter(F.concat(single, double), lambda k: near.passes(b[0], k)))

    rows = id_text(docs).select(F.explode(let(units(F.col("text")), keys)).alias("key"))
    return rows.groupBy("key").agg(F.count("*").alias("n")).join(induced, "key")


def graph(scanned: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges (side, pattern, value, seed) of the patterns that seeds induce, and per pattern
    how many of its occurrences in the corpus have no instance (bare)."""
    cues = scanned.select(F.explode("cues").alias("c")).select(F.explode("c.patterns").alias("p"), F.sha2("c.value", 256).alias("value"), "c.seed").select(
        "p.*", "value", "seed")
    every = materialize(cues.groupBy("side", "pattern", "key", "value").agg(F.max("seed").alias("seed"), F.count("*").alias("uses")))
    induced = every.groupBy("side", "pattern", "key").agg(F.max("seed").alias("s"), F.sum("uses").alias("uses")).where("s").drop("s")
    induced = materialize(induced)
    seen = materialize(occurrences(docs, induced.select("key").distinct()))
    bare = materialize(induced.join(seen, "key", "left").select("side", "pattern", F.greatest(F.coalesce("n", F.lit(0)) - F.col("uses"), F.lit(0)).alias("bare")))
    return materialize(every.join(induced.select("side", "pattern"), ["side", "pattern"], "left_semi").select("side", "pattern", "value", "seed")), bare


def trusted_patterns(scanned: DataFrame, docs: DataFrame, confidence: float = 0.7, support: float = 3.0, settled: float = 0.001) -> DataFrame:
    """(side, pattern, confidence, weight) of the patterns that may mark unseen identifiers."""
    edges, bare = graph(scanned, docs)
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    while True:
        patterns = scored.groupBy("side", "pattern").agg(F.sum("score").alias("weight"), F.count("*").alias("n")).join(bare, ["side", "pattern"])
        patterns = materialize(patterns.select("side", "pattern", "weight", (F.col("weight") / (F.col("n") + F.col("bare") + 1)).alias("confidence")))
        doubt = F.log1p(-F.least(F.col("confidence"), F.lit(0.999999)))
        reached = edges.where("not seed").join(patterns, ["side", "pattern"]).groupBy("value").agg((1 - F.exp(F.sum(doubt))).alias("reach"))
        new = scored.join(reached, "value", "left").withColumn("new", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("reach", F.lit(0.0))))
        new = materialize(new.select("side", "pattern", "value", "seed", F.col("new").alias("score"), (F.col("new") - F.col("score")).alias("grown")))
        scored = new.drop("grown")
        if not new.where(F.col("grown") > settled).limit(1).count():
            return patterns.where((F.col("confidence") >= confidence) & (F.col("weight") >= support))


def found_spans(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """(doc_id, text_hash, found): the added spans of the documents that have some."""
    cues = scanned.select("doc_id", "text_hash", F.explode("cues").alias("c")).where("c.open").select(
        "doc_id", "text_hash", "c.value", "c.start", "c.end", F.explode("c.patterns").alias("p"))
    span = F.struct(F.lit(FOUND).alias("kind"), F.lit(len(KINDS)).alias("rank"), "start", "end", F.col("value"))
    met = cues.select("doc_id", "text_hash", "value", "start", "end", "p.side", "p.pattern").join(patterns.select("side", "pattern"), ["side", "pattern"])
    return met.groupBy("doc_id", "text_hash").agg(F.collect_set(span).alias("found"))


def report(docs: DataFrame) -> DataFrame:
    """One row: seeds, other_instances (spans), patterns (induced), trusted (patterns), found (spans)."""
    scanned = materialize(scan(docs))
    edges, _ = graph(scanned, docs)
    patterns = materialize(trusted_patterns(scanned, docs))
    cues = scanned.select(F.explode("cues").alias("c"))
    count = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("_", F.lit(1))
    parts = [count(cues.where("c.seed"), "seeds"), count(cues.where("c.open"), "other_instances"), count(edges.select("side", "pattern").distinct(), "patterns"),
             count(patterns, "trusted"), count(found_spans(scanned, patterns).select(F.explode("found")), "found")]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "_")
    return out.drop("_")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, base, found: base spans and those that the method adds."""
    scanned = materialize(scan(docs))
    found = materialize(found_spans(scanned, trusted_patterns(scanned, docs)))
    same = scanned["doc_id"].eqNullSafe(found["doc_id"]) & (scanned["text_hash"] == found["text_hash"])
    return scanned.join(found, same, "left").select(
        scanned["doc_id"], scanned["text_hash"], "base", F.coalesce("found", F.array().cast(SPAN)).alias("found"))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by [KIND]; a null text stays null.
    Base spans are found again in place, so that only the few added ones are joined."""
    scanned = materialize(scan(docs))
    found = materialize(found_spans(scanned, trusted_patterns(scanned, docs)))
    found = found.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("found").alias("_found"))
    rows = docs.join(found, docs["doc_id"].eqNullSafe(found["_doc"]) & (F.xxhash64(docs["text"]) == found["_hash"]), "left")
    rows = rows.withColumn("_spans", F.concat(base_spans(docs["text"]), F.coalesce("_found", F.array().cast(SPAN))))
    text = F.when(docs["text"].isNotNull(), masked(docs["text"], F.col("_spans")))
    return rows.select(*(text.alias("text") if c == "text" else docs[c] for c in docs.columns))


def op4_personal_data(spark, sf_dir: str) -> DataFrame:
    order = lambda s: F.struct(s["rank"], s["start"], s["end"])
    marked = personal_data(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id", *(count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS),
        F.sha2(written(F.col("base"), order).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("base", "found"), order).alias("spans"))
