"""Natural-key dedupe (W17), dedupe counts (W16, D17) and full-row distinct.

Every dedupe is an aggregate keyed by the natural key, so a group with millions of
copies is collapsed by the map-side partial aggregation before the shuffle.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import cdm_columns, natural_key, primary_key

# Date column and domain code inside each table's occurrence id: hosp YYMMDD code sequence.
ID_PARTS = {
    "visit_occurrence": ("visit_start_date", "01"), "condition_occurrence": ("condition_start_date", "02"),
    "drug_exposure": ("drug_exposure_start_date", "03"), "procedure_occurrence": ("procedure_date", "04"),
    "measurement": ("measurement_date", "05"), "observation": ("observation_date", "06"),
    "payer_plan_period": ("payer_plan_period_start_date", "07"), "note": ("note_date", "09"),
}


LONG_TEXT = {"note_text"}  # key columns of unbounded length


def sequence_of(table: str) -> Column:
    """Sequence part of an occurrence id: what stands behind the row's own date and the
    domain code, however many digits the hospital has; without a date in the row, behind
    nine digits (null for an id of another make)."""
    if table not in ID_PARTS:
        return F.lit(None).cast("bigint")
    date, code = ID_PARTS[table]
    text = F.col(primary_key(table)).cast("string")
    middle = F.concat(F.date_format(F.col(date).cast("date"), "yyMMdd"), F.lit(code))
    at = F.call_function("locate", middle, text, F.lit(2))  # behind one digit at least
    behind = F.when(at > 0, at + F.length(middle)).otherwise(F.lit(10))
    return F.substring(text, behind, F.length(text)).try_cast("bigint")


def keep_rule(table: str) -> str:
    """Which of several copies stays: visits the lowest id (events point to it), other
    tables the row numbered first."""
    return "lowest" if table == "visit_occurrence" else "sequence"


def dedupe_natural_key(df: DataFrame, table: str, *, keep: str = "sequence") -> DataFrame:
    """One row per natural key (all columns but the surrogate key; nulls equal).

    ``keep="sequence"``: the row numbered first wins (lowest sequence, which is
    the input order of event tables); ``keep="lowest"``: lowest id
    (visits, saved in id order).  Tables keyed by ``person_id`` use all columns.
    """
    cols = cdm_columns(table)
    pk = primary_key(table)
    if pk == "person_id":
        return df.select(*cols).distinct()
    nk = natural_key(table)
    order = sequence_of(table) if keep == "sequence" else F.col(pk)
    first = F.min(F.struct(F.coalesce(order, F.col(pk)).alias("o"), F.col(pk).alias("k")))
    long_text = [c for c in nk if c in LONG_TEXT]
    if not long_text:
        agg = df.groupBy(*nk).agg(first.alias("_m"))
        return agg.select(*[F.col("_m.k").alias(c) if c == pk else F.col(c) for c in cols])
    # Long texts are not shuffled as group keys: their hash stands for them, and the
    # text comes from the row that stays.
    hashed = [F.sha2(F.col(c), 256).alias(f"_h_{c}") if c in long_text else F.col(c) for c in nk]
    keep_row = F.min_by(F.struct(*long_text), F.struct(F.coalesce(order, F.col(pk)), F.col(pk)))
    agg = df.groupBy(*hashed).agg(first.alias("_m"), keep_row.alias("_t"))
    return agg.select(*[F.col("_m.k").alias(c) if c == pk else F.col(f"_t.{c}").alias(c) if c in long_text else F.col(c) for c in cols])


def dedupe_counts(tables: Mapping[str, DataFrame], *, keep: str = "sequence") -> DataFrame:
    """(table_name, rows_before, rows_after, removed) per CDM table."""
    parts = []
    for name, df in tables.items():
        before = df.select(F.lit(name).alias("table_name"), F.lit("before").alias("k"))
        after = dedupe_natural_key(df, name, keep=keep).select(F.lit(name).alias("table_name"),
                                                               F.lit("after").alias("k"))
        parts += [before, after]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    agg = u.groupBy("table_name").agg(F.count_if(F.col("k") == "before").alias("rows_before"),
                                      F.count_if(F.col("k") == "after").alias("rows_after"))
    return agg.withColumn("removed", F.col("rows_before") - F.col("rows_after"))
