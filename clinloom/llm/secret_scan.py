"""Secrets and their ownership over the whole corpus, native only.

Candidates are the matches of the base patterns and of further credential formats.  The
hash of a candidate's value is counted by distinct repositories and distinct owners: a
value that ``wide`` owners or ``many`` repositories hold is a copied example, one that
fewer hold and that has many different characters looks live.  Documents of equal text
count as one repository, so exact copies of a document do not make its values copied.  Base spans always stay; a candidate of the further
formats becomes a span (kind ``live``) where its value looks live.

The text is read once.  (value, owner) and (value, repository) pairs are made distinct
with map-side combination before they are counted, so a value in a third of all documents
is a few rows per task; its class goes back through a join that Spark can split.

Defined results: a null text counts as empty; a null owner or repository is one more
owner or repository; repeated rows give equal results; a null doc_id stays null; other
columns are ignored; an empty table gives an empty one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import id_text, table
from clinloom.llm.text_spans import SPAN, count_kind, find_spans, written
from clinloom.session import materialize

KINDS = ("assign", "access", "hex")
FOUND = "live"
OWNERSHIP = "array<struct<value_hash:string,owners:bigint,repositories:bigint>>"

ASSIGN = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]++"
ASSIGN_VALUE = r"(?i)^(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"
ACCESS = "AKIA[A-Z0-9]{14,}+"  # a run of fewer characters fails the length test anyway
HEX = "[0-9a-f]{16,}+"
# Public prefixes of issued credentials (fixed values).
ISSUED = r"(?<![A-Za-z0-9_])(?:ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|rk_live_|xoxb-|xoxp-|xoxa-|AIza|ya29\.|eyJ)[A-Za-z0-9_.-]{16,}+"


def secret_value(span: Column) -> Column:
    """What is compared between documents: the value of an assignment, else the match."""
    return F.when(span["kind"] == "assign", F.regexp_extract(span["value"], ASSIGN_VALUE, 1)).otherwise(span["value"])


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, owner, repository, base, issued) from one pass over the texts."""
    text = F.col("text")
    keys = docs.select("doc_id", "text", F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"))
    return id_text(keys, "owner", "repository").select(
        "doc_id", F.xxhash64(text).alias("text_hash"), "owner", "repository",
        F.concat(find_spans(text, "assign", 0, ASSIGN, text.rlike(r"(?i)(?:passw|secret|token|key)[od\"'\x20:=]"),
                            lambda v: F.length(F.regexp_extract(v, ASSIGN_VALUE, 1)) >= 12),
                 find_spans(text, "access", 1, ACCESS, F.contains(text, F.lit("AKIA")), lambda v: F.lit(True)),
                 find_spans(text, "hex", 2, HEX, text.rlike(HEX), lambda v: F.lit(True))).alias("base"),
        find_spans(text, FOUND, len(KINDS), ISSUED, text.rlike("gh|gl|sk_|rk_|xox|AI|ya|ey"), lambda v: F.lit(True)).alias("issued"))


def ownership(scanned: DataFrame, wide: int = 3, many: int = 10, least_distinct: int = 8) -> DataFrame:
    """(value_hash, owners, repositories, copied, live) of every candidate value.  Copied: at
    least ``wide`` owners or ``many`` repositories; live-looking: not copied and at least
    ``least_distinct`` different characters."""
    uses = scanned.select("text_hash", "owner", "repository", F.explode(F.concat("base", "issued")).alias("s")).select(
        "text_hash", "owner", "repository", F.sha2(secret_value(F.col("s")), 256).alias("value_hash"),
        F.size(F.array_distinct(F.split(secret_value(F.col("s")), ""))).alias("distinct"))
    owners = uses.groupBy("value_hash", "owner").agg(F.max("distinct").alias("distinct")).groupBy("value_hash").agg(
        F.count("*").alias("owners"), F.max("distinct").alias("distinct"))
    folded = uses.groupBy("value_hash", "text_hash").agg(F.min("repository").alias("repository"))
    repos = folded.groupBy("value_hash", "repository").agg(F.lit(1)).groupBy("value_hash").agg(F.count("*").alias("repositories"))
    copied = (F.col("owners") >= wide) | (F.col("repositories") >= many)
    return owners.join(repos, "value_hash").select(
        "value_hash", "owners", "repositories", copied.alias("copied"), (~copied & (F.col("distinct") >= least_distinct)).alias("live"))


def secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", wide: int = 3, many: int = 10) -> DataFrame:
    """doc_id, text_hash, base, found, n_live, n_copied, ownership: base spans, the added
    spans, how many distinct values of the document look live or are widely copied, and
    each distinct value's hash with its owners and repositories."""
    scanned = materialize(scan(docs, owner, repository))
    classes = materialize(ownership(scanned, wide, many))
    spans = scanned.select("doc_id", "text_hash", F.explode(F.concat("base", "issued")).alias("s")).distinct()
    judged = spans.withColumn("value_hash", F.sha2(secret_value(F.col("s")), 256)).join(classes, "value_hash")
    per_doc = judged.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(F.col("live") & (F.col("s.kind") == FOUND), F.col("s"))).alias("found"),
        F.size(F.collect_set(F.when(F.col("live"), F.col("value_hash")))).cast("long").alias("n_live"),
        F.size(F.collect_set(F.when(F.col("copied"), F.col("value_hash")))).cast("long").alias("n_copied"),
        F.array_sort(F.collect_set(F.struct("value_hash", "owners", "repositories"))).alias("ownership"))
    per_doc = materialize(per_doc)
    same = scanned["doc_id"].eqNullSafe(per_doc["doc_id"]) & (scanned["text_hash"] == per_doc["text_hash"])
    return scanned.join(per_doc, same, "left").select(
        scanned["doc_id"], scanned["text_hash"], "base", F.coalesce("found", F.array().cast(SPAN)).alias("found"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
        F.coalesce("ownership", F.array().cast(OWNERSHIP)).alias("ownership"))


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    order = lambda s: F.struct(s["start"], s["rank"], s["end"])
    marked = secrets(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id", *(count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS),
        F.sha2(written(F.col("base"), order).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("base", "found"), order).alias("spans"), "n_live", "n_copied", "ownership")
