"""Care site and provider roll-ups."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import select_columns


def site_rollup(provider_list: DataFrame, *, order_col: str = "_ord") -> DataFrame:
    """A1: per ``care_site_id``: distinct raw names joined with ``", "`` in input
    order (T28: a name repeats when it comes with two concepts) and the first
    non-null concept (0 if none).

    Exact duplicates collapse first (map-side), so only distinct
    (site, name, concept) rows reach the per-site list.
    """
    d = (provider_list.groupBy("care_site_id", "care_site_rawname", "concept_id")
         .agg(F.min(order_col).alias("_o")))
    named = F.when(F.col("care_site_rawname").isNotNull(),
                   F.struct(F.col("_o"), F.col("care_site_rawname").cast("string").alias("n")))
    agg = d.groupBy("care_site_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(named)), lambda x: x["n"]), ", ").alias("names"),
        F.min(F.when(F.col("concept_id").isNotNull(), F.struct(F.col("_o"), F.col("concept_id").alias("c"))))
        .alias("_fc"),
    )
    return agg.select("care_site_id", "names",
                      F.coalesce(F.col("_fc.c").cast("bigint"), F.lit(0).cast("bigint")).alias("first_concept"))


def care_site_build(provider_list: DataFrame) -> DataFrame:
    """D3: care_site table, ordered by id (O3)."""
    r = site_rollup(provider_list)
    out = r.select(F.col("care_site_id"), F.col("names").alias("care_site_name"),
                   F.col("first_concept").alias("place_of_service_concept_id"),
                   F.lit(None).cast("bigint").alias("location_id"),
                   F.lit("").alias("care_site_source_value"), F.lit("").alias("place_of_service_source_value"))
    return select_columns(out, "care_site").orderBy("care_site_id")


def provider_build(provider_list: DataFrame) -> DataFrame:
    """Provider table; provider_id = care_site_id, specialty = first concept."""
    r = site_rollup(provider_list)
    out = r.select(
        F.col("care_site_id").alias("provider_id"), F.col("names").alias("provider_name"),
        F.lit("").alias("npi"), F.lit("").alias("dea"), F.col("first_concept").alias("specialty_concept_id"),
        F.col("care_site_id"), F.lit(None).cast("int").alias("year_of_birth"),
        F.lit(0).cast("bigint").alias("gender_concept_id"), F.lit("").alias("provider_source_value"),
        F.lit("").alias("specialty_source_value"), F.lit(0).cast("bigint").alias("specialty_source_concept_id"),
        F.lit("").alias("gender_source_value"), F.lit(0).cast("bigint").alias("gender_source_concept_id"))
    return select_columns(out, "provider").orderBy("provider_id")
