"""Data-quality checks over built CDM tables, returned as report DataFrames.

Each check is one aggregate per table (partial aggregation on the map side, one
row per table out); its scan reads only the columns the check needs (Parquet
column pruning).  Foreign-key checks are anti / left joins against the key
tables; AQE decides at run time whether the key side is broadcast.
"""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per-table QC spec (primary key, person FK, main date, end date,
# concept column, visit FK).
QC_SPEC: dict[str, dict] = {
    "person": {"pk": "person_id", "person_fk": False},
    "death": {"pk": None, "person_fk": True, "date": "death_date"},
    "visit_occurrence": {"pk": "visit_occurrence_id", "person_fk": True, "date": "visit_start_date",
                         "end": "visit_end_date"},
    "condition_occurrence": {"pk": "condition_occurrence_id", "person_fk": True, "date": "condition_start_date",
                             "concept": "condition_concept_id", "visit_fk": True},
    "drug_exposure": {"pk": "drug_exposure_id", "person_fk": True, "date": "drug_exposure_start_date",
                      "concept": "drug_concept_id", "visit_fk": True},
    "procedure_occurrence": {"pk": "procedure_occurrence_id", "person_fk": True, "date": "procedure_date",
                             "concept": "procedure_concept_id"},
    "measurement": {"pk": "measurement_id", "person_fk": True, "date": "measurement_date",
                    "concept": "measurement_concept_id", "visit_fk": True},
    "observation": {"pk": "observation_id", "person_fk": True, "date": "observation_date",
                    "concept": "observation_concept_id", "visit_fk": True},
    "note": {"pk": "note_id", "person_fk": True, "date": "note_date", "visit_fk": True},
}
DATE_LO, DATE_HI = "2001-01-01", "2027-01-01"  # T25: upper bound is a parameter


def _union(frames: list[DataFrame]) -> DataFrame | None:
    """Union of the per-table results; ``None`` when the check applies to no table."""
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def qc_pk(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows beyond the first per key value (a null counts as one value, T32) and nulls."""
    out = []
    for name, df in tables.items():
        pk = QC_SPEC.get(name, {}).get("pk")
        if not pk or pk not in df.columns:
            continue
        c = F.col(pk)
        out.append(df.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            (F.count(F.lit(1)) - F.count_distinct(c) - F.when(F.count_if(c.isNull()) > 0, 1).otherwise(0))
            .cast("bigint").alias("pk_duplicates"),
            F.count_if(c.isNull()).alias("pk_nulls")))
    return _union(out)


def qc_person_fk(tables: Mapping[str, DataFrame], person: DataFrame) -> DataFrame:
    """Rows whose person is not in the person table."""
    ids = person.select("person_id").distinct()
    out = []
    for name, df in tables.items():
        if not QC_SPEC.get(name, {}).get("person_fk") or "person_id" not in df.columns:
            continue
        miss = df.select("person_id").join(ids, "person_id", "left_anti")
        out.append(miss.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("person_fk_missing")))
    return _union(out)


def qc_visit_fk(tables: Mapping[str, DataFrame], visit: DataFrame) -> DataFrame:
    """Non-null visit ids missing from the visit table; matched and total rows."""
    ids = visit.select(F.col("visit_occurrence_id").alias("_vid"), F.lit(True).alias("_hit")).distinct()
    out = []
    for name, df in tables.items():
        if not QC_SPEC.get(name, {}).get("visit_fk") or "visit_occurrence_id" not in df.columns:
            continue
        j = df.select(F.col("visit_occurrence_id").alias("_vid")).join(ids, "_vid", "left")
        out.append(j.agg(F.lit(name).alias("table_name"),
                         F.count_if(F.col("_vid").isNotNull() & F.col("_hit").isNull()).alias("visit_fk_missing"),
                         F.count(F.col("_vid")).alias("visit_non_null"), F.count(F.lit(1)).alias("n_rows")))
    return _union(out)


def qc_mapping_rate(tables: Mapping[str, DataFrame]) -> DataFrame:
    """100 * (n - zeros) / n, a null concept counting as zero; rounded to 0.1."""
    out = []
    for name, df in tables.items():
        c = QC_SPEC.get(name, {}).get("concept")
        if not c or c not in df.columns:
            continue
        zero = F.count_if(F.coalesce(F.col(c).cast("bigint"), F.lit(0)) == 0)
        n = F.count(F.lit(1))
        out.append(df.agg(F.lit(name).alias("table_name"), n.alias("n_rows"), zero.alias("n_unmapped"),
                          F.when(n > 0, F.round(100.0 * (n - zero) / n, 1)).otherwise(F.lit(0.0))
                          .alias("mapping_rate")))
    return _union(out)


def qc_date_range(tables: Mapping[str, DataFrame], *, lo: str = DATE_LO, hi: str = DATE_HI) -> DataFrame:
    """A10: dates outside ``[lo, hi)``, and the min / max date."""
    out = []
    for name, df in tables.items():
        d = QC_SPEC.get(name, {}).get("date")
        if not d or d not in df.columns:
            continue
        dc = F.col(d).cast("date")
        out.append(df.agg(F.lit(name).alias("table_name"),
                          F.count_if((dc < F.lit(lo).cast("date")) | (dc >= F.lit(hi).cast("date")))
                          .alias("out_of_range"), F.min(dc).alias("min_date"), F.max(dc).alias("max_date")))
    return _union(out)


def qc_after_death(tables: Mapping[str, DataFrame], death: DataFrame) -> DataFrame:
    """Events dated after the person's death."""
    dd = death.groupBy("person_id").agg(F.min("death_date").alias("_dd"))
    out = []
    for name, df in tables.items():
        d = QC_SPEC.get(name, {}).get("date")
        if not d or d not in df.columns or "person_id" not in df.columns:
            continue
        j = df.select("person_id", F.col(d).cast("date").alias("_d")).join(dd, "person_id", "inner")
        out.append(j.agg(F.lit(name).alias("table_name"), F.count_if(F.col("_d") > F.col("_dd")).alias("after_death")))
    return _union(out)


def qc_start_end(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Start date after end date."""
    out = []
    for name, df in tables.items():
        spec = QC_SPEC.get(name, {})
        if not spec.get("end") or spec["end"] not in df.columns:
            continue
        out.append(df.agg(F.lit(name).alias("table_name"),
                          F.count_if(F.col(spec["date"]) > F.col(spec["end"])).alias("start_after_end")))
    return _union(out)


def _people(person: DataFrame | None, death: DataFrame | None) -> DataFrame | None:
    """(person_id, _known, _dd): the master's persons and the first death of each person."""
    parts = []
    if person is not None:
        parts.append(person.select("person_id", F.lit(True).alias("_known"), F.lit(None).cast("date").alias("_dd")))
    if death is not None:
        parts.append(death.select("person_id", F.lit(None).cast("boolean").alias("_known"), F.col("death_date").cast("date").alias("_dd")))
    both = _union(parts)
    return None if both is None else both.groupBy("person_id").agg(F.max("_known").alias("_known"), F.min("_dd").alias("_dd"))


def _rows(frame: DataFrame, name: str, checks: list[tuple[str, Column, str]]) -> DataFrame | None:
    """One aggregate over ``frame``, a row per (check, count, severity if not 0)."""
    if not checks:
        return None
    one = frame.agg(*[n.cast("bigint").alias(check) for check, n, _ in checks])
    found = F.explode(F.array(*[F.struct(F.lit(check).alias("check_name"), F.col(check).alias("n"), F.lit(bad).alias("bad"))
                                for check, _, bad in checks])).alias("r")
    rows = one.select(found).where((F.col("r.check_name") != "pk_nulls") | (F.col("r.n") > 0))
    return rows.select(F.lit(name).alias("table_name"), "r.check_name", "r.n",
                       F.when(F.col("r.n") > 0, F.col("r.bad")).otherwise(F.lit("OK")).alias("severity"))


def qc_report(tables: Mapping[str, DataFrame], *, lo: str = DATE_LO, hi: str = DATE_HI) -> DataFrame:
    """One row per (table, check) with its count and severity ERROR / WARN / OK.

    A table is read once for A8-A11, once against the persons (J18 and J20 in one join)
    and once against the visits (J19)."""
    person, visit, death = tables.get("person"), tables.get("visit_occurrence"), tables.get("death")
    people = _people(person, death)
    visits = None if visit is None else visit.select(F.col("visit_occurrence_id").alias("_vid"), F.lit(True).alias("_hit")).distinct()
    parts: list[DataFrame | None] = []
    for name, df in tables.items():
        spec = QC_SPEC.get(name, {})
        has = {k: v for k in ("pk", "date", "end", "concept") if (v := spec.get(k)) and v in df.columns}
        own: list[tuple[str, Column, str]] = []
        if "pk" in has:
            c = F.col(has["pk"])
            nulls = F.count_if(c.isNull())
            own += [("pk_duplicates", F.count(F.lit(1)) - F.count_distinct(c) - F.when(nulls > 0, 1).otherwise(0), "ERROR"),
                    ("pk_nulls", nulls, "ERROR")]
        if "concept" in has:
            own.append(("concept_unmapped", F.count_if(F.coalesce(F.col(has["concept"]).cast("bigint"), F.lit(0)) == 0), "WARN"))
        if "date" in has:
            day = F.col(has["date"]).cast("date")
            own.append(("date_range", F.count_if((day < F.lit(lo).cast("date")) | (day >= F.lit(hi).cast("date"))), "WARN"))
        if "end" in has:
            own.append(("start_after_end", F.count_if(F.col(spec["date"]) > F.col(has["end"])), "ERROR"))
        parts.append(_rows(df, name, own))
        joined: list[tuple[str, Column, str]] = []
        if person is not None and spec.get("person_fk") and "person_id" in df.columns:
            joined.append(("person_fk", F.count_if(F.col("_known").isNull()), "ERROR"))
        if death is not None and "date" in has and "person_id" in df.columns:
            joined.append(("after_death", F.count_if(F.col(has["date"]).cast("date") > F.col("_dd")), "ERROR"))
        if joined:
            parts.append(_rows(df.select("person_id", *([has["date"]] if "date" in has else [])).join(people, "person_id", "left"), name, joined))
        if visits is not None and spec.get("visit_fk") and "visit_occurrence_id" in df.columns:
            seen = df.select(F.col("visit_occurrence_id").alias("_vid")).where("_vid is not null").join(visits, "_vid", "left")
            parts.append(_rows(seen, name, [("visit_fk", F.count_if(F.col("_hit").isNull()), "ERROR")]))
    return _union([p for p in parts if p is not None])


def qc_totals(report: DataFrame) -> DataFrame:
    """Totals of the report: number of ERROR and WARN rows."""
    return report.agg(F.count_if(F.col("severity") == "ERROR").alias("n_error"),
                      F.count_if(F.col("severity") == "WARN").alias("n_warn"))
