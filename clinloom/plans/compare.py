"""D15 (CDM-to-CDM gap job) and D16 (table-to-table reconciliation).

Key sets are compared with one full outer join of the two distinct key sets
(null-safe keys, T31) and conditional counts; per-code mappings with one full
outer join of two aggregates.  Nothing is collected.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import lenient
from ..schema import CDM_TABLES

# Per-domain natural key, concept column and source value column.
COMPARE_SPEC: dict[str, tuple[list[str], str | None, str | None]] = {
    "condition": (["person_id", "condition_start_date", "condition_source_value"],
                  "condition_concept_id", "condition_source_value"),
    "drug": (["person_id", "drug_exposure_start_date", "drug_source_value"], "drug_concept_id", "drug_source_value"),
    "procedure": (["person_id", "procedure_date", "procedure_source_value"],
                  "procedure_concept_id", "procedure_source_value"),
    "measurement": (["person_id", "measurement_date", "measurement_source_value"],
                    "measurement_concept_id", "measurement_source_value"),
    "observation": (["person_id", "observation_date", "observation_source_value"],
                    "observation_concept_id", "observation_source_value"),
    "note": (["person_id", "note_date"], None, None),
}


DATE_TYPES = {t: {c for c, kind in layout if kind in ("date", "timestamp_ntz", "timestamp")} for t, layout in CDM_TABLES.items()}
DATES = set().union(*DATE_TYPES.values())  # every CDM column that holds a date or a time


def key_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A key that the CDM layouts type as a date or time as ``YYYY-MM-DD`` text (null
    when it is no date), any other as text; names match in any case."""
    own = {c.lower(): c for c in df.columns}
    day = lambda k: F.date_format(lenient(F.col(own[k]), "date"), "yyyy-MM-dd")
    return df.select([(day(k) if k in DATES else F.col(own[k]).cast("string")).alias(k) for k in keys])


def compare_keys(gen: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct natural keys of both sides: (n_both, n_only_gen, n_only_base)."""
    g = key_columns(gen, keys).distinct().withColumn("_g", F.lit(True))
    b = key_columns(base, keys).distinct().withColumn("_b", F.lit(True))
    cond = None
    for k in keys:
        c = g[k].eqNullSafe(b[k])
        cond = c if cond is None else cond & c
    j = g.join(b, cond, "full_outer")
    return j.agg(F.count_if(F.col("_g").isNotNull() & F.col("_b").isNotNull()).alias("n_both"),
                 F.count_if(F.col("_g").isNotNull() & F.col("_b").isNull()).alias("n_only_gen"),
                 F.count_if(F.col("_g").isNull() & F.col("_b").isNotNull()).alias("n_only_base"))


def best_concept(df: DataFrame, source: str, concept: str) -> DataFrame:
    """Highest concept per source value after null -> 0 (non-zero wins)."""
    c = F.coalesce(F.col(concept).cast("string").try_cast("bigint"), F.lit(0))
    return df.groupBy(F.col(source).alias("source_value")).agg(F.max(c).alias("concept_id"))


def compare_mapping(gen: DataFrame, base: DataFrame, source: str, concept: str) -> DataFrame:
    """Per source value: gen / base concept (0 when absent) and the ok flags."""
    g = best_concept(gen, source, concept).withColumnRenamed("concept_id", "gen")
    b = best_concept(base, source, concept).withColumnRenamed("concept_id", "base")
    j = g.join(b, g["source_value"].eqNullSafe(b["source_value"]), "full_outer")
    return j.select(F.coalesce(g["source_value"], b["source_value"]).alias("source_value"),
                    F.coalesce(F.col("gen"), F.lit(0)).alias("gen"), F.coalesce(F.col("base"), F.lit(0)).alias("base")
                    ).withColumn("gen_ok", F.col("gen") != 0).withColumn("base_ok", F.col("base") != 0)


def compare_mapping_counts(comp: DataFrame) -> DataFrame:
    """Agreement counts over the mapping comparison."""
    g, b, gok, bok = F.col("gen"), F.col("base"), F.col("gen_ok"), F.col("base_ok")
    return comp.agg(F.count(F.lit(1)).alias("n_sources"), F.count_if((g == b) & gok).alias("n_same"),
                    F.count_if(~gok & bok).alias("n_base_only"), F.count_if(gok & ~bok).alias("n_gen_only"),
                    F.count_if(gok & bok & (g != b)).alias("n_both_differ"), F.count_if(~gok & ~bok).alias("n_neither"))


def gap_missing(comp: DataFrame) -> DataFrame:
    """Mapped in base but not in gen (supplement candidates)."""
    return comp.where(~F.col("gen_ok") & F.col("base_ok"))


def gap_common_unmapped(comp: DataFrame) -> DataFrame:
    """Unmapped on both sides."""
    return comp.where(~F.col("gen_ok") & ~F.col("base_ok"))


# ---------------------------------------------------------------- D16
def recon_counts(gen: DataFrame, base: DataFrame) -> DataFrame:
    """Row counts, difference and percentage (gen / base)."""
    u = gen.select(F.lit(1).alias("_g"), F.lit(0).alias("_b")).unionByName(
        base.select(F.lit(0).alias("_g"), F.lit(1).alias("_b")))
    a = u.agg(F.sum("_g").cast("bigint").alias("rows_gen"), F.sum("_b").cast("bigint").alias("rows_base"))
    return a.select("rows_gen", "rows_base", (F.col("rows_gen") - F.col("rows_base")).alias("diff"),
                    F.when(F.col("rows_base") > 0, F.round(100.0 * F.col("rows_gen") / F.col("rows_base"), 2))
                    .alias("pct"))


def recon_keys(gen: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U4: per key column: distinct values per side, intersection and differences (nulls ignored)."""
    parts = []
    for k in keys:
        if k not in gen.columns or k not in base.columns:
            continue
        g = gen.select(F.col(k).alias("v")).where(F.col("v").isNotNull()).distinct().withColumn("_g", F.lit(1))
        b = base.select(F.col(k).alias("v")).where(F.col("v").isNotNull()).distinct().withColumn("_b", F.lit(1))
        j = g.join(b, "v", "full_outer")
        parts.append(j.agg(F.lit(k).alias("key_name"), F.count(F.col("_g")).alias("n_gen"),
                           F.count(F.col("_b")).alias("n_base"),
                           F.count_if(F.col("_g").isNotNull() & F.col("_b").isNotNull()).alias("n_both"),
                           F.count_if(F.col("_b").isNull()).alias("n_gen_only"),
                           F.count_if(F.col("_g").isNull()).alias("n_base_only")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recon_columns(spark: SparkSession, gen: DataFrame, base: DataFrame) -> DataFrame:
    """Columns present on one side only (metadata; lower-cased names)."""
    g = {c.lower() for c in gen.columns}
    b = {c.lower() for c in base.columns}
    rows = [(c, "gen") for c in sorted(g - b)] + [(c, "base") for c in sorted(b - g)]
    return spark.createDataFrame(rows, "column_name string, side string")


def recon_concept_top(gen: DataFrame, base: DataFrame, concept: str, n: int = 10) -> DataFrame:
    """J23 + O4: concept distributions side by side (null concepts are not
    counted), the ``n`` largest absolute differences (ties by concept id)."""
    g = (gen.where(F.col(concept).isNotNull()).groupBy(F.col(concept).alias("concept_id"))
         .agg(F.count(F.lit(1)).alias("n_gen")))
    b = (base.where(F.col(concept).isNotNull()).groupBy(F.col(concept).alias("concept_id"))
         .agg(F.count(F.lit(1)).alias("n_base")))
    j = g.join(b, g["concept_id"] == b["concept_id"], "full_outer").select(
        F.coalesce(g["concept_id"], b["concept_id"]).alias("concept_id"),
        F.coalesce(F.col("n_gen"), F.lit(0)).alias("n_gen"), F.coalesce(F.col("n_base"), F.lit(0)).alias("n_base"))
    j = j.withColumn("diff", F.col("n_gen") - F.col("n_base"))
    return j.orderBy(F.abs(F.col("diff")).desc(), F.col("concept_id").asc_nulls_first()).limit(n)


def recon_date_range(gen: DataFrame, base: DataFrame, date_col: str) -> DataFrame:
    """Min / max date on both sides (one aggregate over the tagged union)."""
    u = gen.select(F.col(date_col).cast("date").alias("d"), F.lit("g").alias("s")).unionByName(
        base.select(F.col(date_col).cast("date").alias("d"), F.lit("b").alias("s")))
    return u.agg(F.min(F.when(F.col("s") == "g", F.col("d"))).alias("gen_min"),
                 F.max(F.when(F.col("s") == "g", F.col("d"))).alias("gen_max"),
                 F.min(F.when(F.col("s") == "b", F.col("d"))).alias("base_min"),
                 F.max(F.when(F.col("s") == "b", F.col("d"))).alias("base_max"))
