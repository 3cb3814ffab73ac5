"""Source code -> standard concept mapping.

The vocabulary is two DataFrames (CONCEPT, CONCEPT_RELATIONSHIP), read as
strings.  A mapping table per source vocabulary has one row per source code; it
is joined to the data on the transformed code.  A domain build first looks up the distinct
codes of its feed (``looked_up``), so that what meets the rows, and may be broadcast, follows
the codes in use and not the vocabulary.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import TRANSFORMS

MAPS_TO = "Maps to"


@dataclass(frozen=True)
class MappingRule:
    """Per-domain mapping rule."""
    source_col: str
    vocabulary_id: str
    concept_col: str
    source_concept_col: str
    code_transform: str | None = None
    require_standard: bool = False  # T7 option: only follow edges to standard targets


def _empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")) == ""


def valid_source_concepts(concept: DataFrame, vocabulary_id: str) -> DataFrame:
    """F12 + W14: valid concepts of one vocabulary, one per code (lowest id wins)."""
    c = concept.where((F.col("vocabulary_id") == vocabulary_id) & _empty(F.col("invalid_reason")))
    c = c.select(F.col("concept_code").alias("source_code"),
                 F.col("concept_id").cast("string").try_cast("bigint").alias("cid"),
                 F.coalesce(F.col("standard_concept"), F.lit("")).alias("std")).where(F.col("cid").isNotNull())
    return c.groupBy("source_code").agg(F.min(F.struct("cid", "std")).alias("m")).select(
        "source_code", F.col("m.cid").alias("cid"), F.col("m.std").alias("std"))


def maps_to_edges(relationship: DataFrame, concept: DataFrame | None = None, *,
                  require_standard: bool = False) -> DataFrame:
    """F13 + W15: one valid ``Maps to`` target per concept (the highest id, T7)."""
    r = relationship.where((F.col("relationship_id") == MAPS_TO) & _empty(F.col("invalid_reason")))
    r = r.select(F.col("concept_id_1").cast("string").try_cast("bigint").alias("c1"),
                 F.col("concept_id_2").cast("string").try_cast("bigint").alias("c2")).where(
        F.col("c1").isNotNull() & F.col("c2").isNotNull())
    if require_standard:
        if concept is None:
            raise ValueError("require_standard needs the concept table")
        std = concept.where(F.col("standard_concept") == "S").select(
            F.col("concept_id").cast("string").try_cast("bigint").alias("c2"))
        r = r.join(std, "c2", "left_semi")
    return r.groupBy("c1").agg(F.max("c2").alias("tgt"))


def mapping_table(concept: DataFrame, relationship: DataFrame, vocabulary_id: str, *,
                  require_standard: bool = False) -> DataFrame:
    """J10 + J11: (source_code, source_concept_id, concept_id, mapped) for every
    valid code of the vocabulary.  Standard source -> itself; otherwise its
    ``Maps to`` target, 0 and unmapped when there is none."""
    src = valid_source_concepts(concept, vocabulary_id)
    edges = maps_to_edges(relationship, concept, require_standard=require_standard)
    j = src.join(edges.hint("merge"), src["cid"] == edges["c1"], "left")  # as large as the vocabulary: not for the driver
    is_std = F.col("std") == "S"
    tgt = F.coalesce(F.col("tgt"), F.lit(0))
    return j.select(
        "source_code",
        F.col("cid").alias("source_concept_id"),
        F.when(is_std, F.col("cid")).otherwise(tgt).cast("bigint").alias("concept_id"),
        (is_std | (tgt != 0)).alias("mapped"),
    )


def transform_code(c: Column, code_transform: str | Callable[[Column], Column] | None) -> Column:
    c = c.cast("string")
    if code_transform is None:
        return c
    fn = TRANSFORMS[code_transform] if isinstance(code_transform, str) else code_transform
    return fn(c)


def last_entries(supplement: DataFrame) -> DataFrame:
    """(code, concept_id): of entries that repeat a code the last in input order."""
    rows = supplement.select("code", "concept_id", F.monotonically_increasing_id().alias("_at"))
    return (rows.where(F.col("code").isNotNull() & F.col("concept_id").isNotNull())
            .groupBy("code").agg(F.max_by("concept_id", "_at").alias("concept_id")))


def looked_up(codes: DataFrame, table: DataFrame, supplement: DataFrame | None) -> DataFrame:
    """The entries of the distinct ``codes`` (_code) that have one, written, so that Spark knows
    their size before it plans the join with the rows.  The vocabulary's sides are never broadcast: the
    estimate from their compressed files is far below what they take in the driver."""
    from ..session import materialize
    found = codes.join(table.hint("merge"), "_code", "left")
    if supplement is not None:
        found = found.join(supplement.hint("merge"), "_code", "left")
    return materialize(found.where(F.coalesce(*found.drop("_code").columns).isNotNull()))


def apply_standard_mapping(df: DataFrame, table: DataFrame, rule: MappingRule,
                           supplement: DataFrame | None = None, feed: DataFrame | None = None) -> DataFrame:
    """J15 (+ J16): write the standard and source concept columns, 0 when unmapped;
    rows still at 0 take the supplement's concept (source concept unchanged).  A
    null code maps to 0 and is not reported (T8).  ``feed`` is a cheaper frame that has at
    least the source values of ``df`` (the feed it comes from); codes are looked up in it."""
    code = transform_code(F.col(rule.source_col), rule.code_transform)
    t = table.select(F.col("source_code").alias("_code"), F.col("source_concept_id").alias("_src_cid"),
                     F.col("concept_id").alias("_std_cid"))
    s = None
    if supplement is not None:
        s = last_entries(supplement).withColumnsRenamed({"code": "_code", "concept_id": "_supp"})  # one row per code
    out = df.withColumn("_code", code)
    if feed is not None and rule.source_col in feed.columns:
        out = out.join(looked_up(feed.select(code.alias("_code")).where("_code is not null").distinct(), t, s), "_code", "left")
    else:
        out = out.join(t, "_code", "left")
        out = out if s is None else out.join(s, "_code", "left")
    concept = F.coalesce(F.col("_std_cid"), F.lit(0)).cast("bigint")
    if supplement is not None:
        concept = F.when(concept == 0, F.coalesce(F.col("_supp"), F.lit(0))).otherwise(concept).cast("bigint")
    out = out.withColumn(rule.concept_col, concept).withColumn(
        rule.source_concept_col, F.coalesce(F.col("_src_cid"), F.lit(0)).cast("bigint"))
    return out.drop("_code", "_src_cid", "_std_cid", "_supp")


def code_counts(df: DataFrame, rule: MappingRule) -> DataFrame:
    """A3 + A4: distinct transformed codes with their row counts (nulls excluded)."""
    code = transform_code(F.col(rule.source_col), rule.code_transform)
    return (df.select(code.alias("source_code")).where(F.col("source_code").isNotNull())
            .groupBy("source_code").agg(F.count(F.lit(1)).alias("n_rows")))


def _coded_status(counts: DataFrame, table: DataFrame, supplement: DataFrame | None) -> DataFrame:
    j = counts.join(table, "source_code", "left")
    mapped = F.coalesce(F.col("mapped"), F.lit(False))
    if supplement is not None:
        s = supplement.select(F.col("code").alias("source_code"), F.lit(True).alias("_in_supp")).distinct()
        j = j.join(s, "source_code", "left")
        mapped = mapped | F.coalesce(F.col("_in_supp"), F.lit(False))
    return j.select("source_code", F.coalesce(F.col("source_concept_id"), F.lit(0)).cast("bigint").alias(
        "source_concept_id"), F.coalesce(F.col("concept_id"), F.lit(0)).cast("bigint").alias("concept_id"),
        mapped.alias("mapped"), "n_rows")


def unmapped_report(counts: DataFrame, table: DataFrame, rule: MappingRule,
                    supplement: DataFrame | None = None) -> DataFrame:
    """K5: codes (of ``code_counts``) left unmapped, with row counts."""
    st = _coded_status(counts, table, supplement)
    return st.where(~F.col("mapped")).select(F.lit(rule.vocabulary_id).alias("vocabulary_id"), "source_code",
                                             "source_concept_id", "concept_id", "mapped", "n_rows")


def used_concept_ids(counts: DataFrame, table: DataFrame, rule: MappingRule,
                     supplement: DataFrame | None = None) -> DataFrame:
    """A5: mapped targets and source concepts of the codes present (``code_counts``), plus every
    supplement target; zero removed."""
    st = _coded_status(counts, table, None)
    parts = [st.select(F.col("concept_id").alias("concept_id")),
             st.select(F.col("source_concept_id").alias("concept_id"))]
    if supplement is not None:
        parts.append(supplement.select(F.col("concept_id").cast("bigint").alias("concept_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("concept_id").isNotNull() & (F.col("concept_id") != 0)).distinct()


def used_concepts(concept: DataFrame, used: DataFrame) -> DataFrame:
    """CONCEPT rows whose id is used."""
    c = concept.withColumn("_cid", F.col("concept_id").cast("string").try_cast("bigint"))
    return c.join(used.select(F.col("concept_id").alias("_cid")), "_cid", "left_semi").drop("_cid")


def used_relationships(relationship: DataFrame, used: DataFrame) -> DataFrame:
    """Relationships with both ends used."""
    u = used.select(F.col("concept_id").alias("_u"))
    r = (relationship.withColumn("_c1", F.col("concept_id_1").cast("string").try_cast("bigint"))
         .withColumn("_c2", F.col("concept_id_2").cast("string").try_cast("bigint")))
    r = r.join(u.withColumnRenamed("_u", "_c1"), "_c1", "left_semi")
    r = r.join(u.withColumnRenamed("_u", "_c2"), "_c2", "left_semi")
    return r.drop("_c1", "_c2")


def used_vocabularies(vocabulary: DataFrame, concept: DataFrame, used: DataFrame) -> DataFrame:
    """Vocabularies of the used concepts."""
    v = used_concepts(concept, used).select("vocabulary_id").distinct()
    return vocabulary.join(v, "vocabulary_id", "left_semi")
