"""Person-level filters, checks and keep-first rules.

F1, F4-F11, F16, J1-J6, W9, W10, W12, W13, A6.  All joins are on the person key;
broadcast is left to AQE, which checks the real size of a side at run time and
keeps the sort-merge join beyond the threshold.
"""
from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EXCLUSION_MARKER, born_after, id_length, integral_long, sex_to_gender


# ---------------------------------------------------------------- keep-first
def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (ascending, nulls last).

    Written as ``min(struct(order..., rest...))`` so it aggregates partially on the
    map side: a key with millions of copies never reaches one task whole.
    """
    rest = [c for c in df.columns if c not in keys]
    fields: list[Column] = []
    for i, o in enumerate(order):
        fields += [F.col(o).isNull().alias(f"_n{i}"), F.col(o).alias(f"_o{i}")]
    packed = F.struct(*fields, *[F.col(c).alias(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_m"))
    return agg.select(*[F.col(c) if c in keys else F.col("_m")[c].alias(c) for c in df.columns])


# ---------------------------------------------------------------- filters
def before_year(date_col: str, cutoff_year: int) -> Column:
    return F.col(date_col).cast("date") < F.lit(date(cutoff_year, 1, 1))


def apply_cutoff(df: DataFrame, *, date_col: str, cutoff_year: int) -> DataFrame:
    """keep ``date < Jan 1 of cutoff_year``; a null date is dropped."""
    return df.where(before_year(date_col, cutoff_year))


def date_window(df: DataFrame, *, date_col: str, start: str, end: str) -> DataFrame:
    """inclusive ``[start, end]`` on the date."""
    d = F.col(date_col).cast("date")
    return df.where((d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date")))


def id_of_length(person: Column, length: int) -> Column:
    pid = integral_long(person)
    return pid.isNotNull() & (id_length(pid) == length)


def longer_id(person: Column, length: int) -> Column:
    return id_length(person) > length


def filter_person_id_length(df: DataFrame, *, person_col: str = "person_id", length: int = 8) -> DataFrame:
    """integral person id written with exactly ``length`` characters."""
    return df.where(id_of_length(F.col(person_col), length))


def filter_person_id_longer_than(df: DataFrame, *, person_col: str = "person_id", length: int = 1) -> DataFrame:
    """id text longer than ``length`` characters (observation keeps > 1)."""
    return df.where(longer_id(F.col(person_col), length))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """F8-F10."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def exclusion_predicate(name: Column, year_of_birth: Column, marker: str = EXCLUSION_MARKER) -> Column:
    """the name carries the deletion marker and the birth year is before 1900."""
    return F.coalesce(name.cast("string").contains(marker), F.lit(False)) & F.coalesce(
        year_of_birth.cast("string").try_cast("double") < 1900, F.lit(False))


def excluded_persons(sheet: DataFrame, *, marker: str = EXCLUSION_MARKER) -> DataFrame:
    """S8 + F11: distinct person ids to exclude from an override / exclusion sheet."""
    return (sheet.where(exclusion_predicate(F.col("name"), F.col("year_of_birth"), marker))
            .select(integral_long(F.col("person_id")).alias("person_id"))
            .where(F.col("person_id").isNotNull()).distinct())


# ---------------------------------------------------------------- joins
def first_death(death: DataFrame, *, person_col: str = "person_id") -> DataFrame:
    """Earliest death date per person (map-side partial aggregation)."""
    return death.groupBy(person_col).agg(F.min(F.col("death_date").cast("date")).alias("_death_date"))


def remove_after_death(df: DataFrame, death: DataFrame, *, date_col: str, person_col: str = "person_id") -> DataFrame:
    """Keep rows without a death or dated on/before the death date.

    A null event date of a dead person is dropped, as the comparison is unknown.
    """
    dd = first_death(death, person_col=person_col)
    j = df.join(dd, person_col, "left")
    keep = F.col("_death_date").isNull() | (F.col(date_col).cast("date") <= F.col("_death_date"))
    return j.where(keep).drop("_death_date")


def exclude_persons(df: DataFrame, excluded: DataFrame, *, person_col: str = "person_id") -> DataFrame:
    """Anti join; rows with a null person are kept."""
    return df.join(excluded.select(F.col("person_id").alias(person_col)).distinct(), person_col, "left_anti")


def keep_in_person_master(df: DataFrame, person: DataFrame, *, person_col: str = "person_id") -> DataFrame:
    """Semi join on the person master."""
    return df.join(person.select(F.col("person_id").alias(person_col)), person_col, "left_semi")


def validate_against_person(df: DataFrame, person: DataFrame, *, date_col: str | None = None,
                            person_col: str = "person_id") -> DataFrame:
    """Distinct violating person ids: not in the master (or a master row with a
    null birth year, T33), or born after the event's year-month."""
    p = person.select(F.col("person_id").alias(person_col), F.col("year_of_birth").alias("_yob"),
                      F.col("month_of_birth").alias("_mob"))
    j = df.select(person_col, *([date_col] if date_col else [])).join(p, person_col, "left")
    bad = F.col("_yob").isNull()
    if date_col is not None:
        bad = bad | F.coalesce(born_after(F.col("_yob"), F.col("_mob"), F.col(date_col).cast("date")), F.lit(False))
    return j.where(bad).select(F.col(person_col).alias("person_id")).distinct()


def split_by_person_master(df: DataFrame, person: DataFrame, *, date_col: str | None,
                           person_col: str = "person_id") -> tuple[DataFrame, DataFrame]:
    """J4 and J3 from one left join: (rows kept in the master, violating ids).

    Persist the input when both outputs are used, so the join runs once.
    """
    p = person.select(F.col("person_id").alias(person_col), F.col("year_of_birth").alias("_yob"),
                      F.col("month_of_birth").alias("_mob"), F.lit(True).alias("_in_master"))
    j = df.join(p, person_col, "left")
    bad = F.col("_yob").isNull()
    if date_col is not None:
        bad = bad | F.coalesce(born_after(F.col("_yob"), F.col("_mob"), F.col(date_col).cast("date")), F.lit(False))
    kept = j.where(F.col("_in_master").isNotNull()).drop("_yob", "_mob", "_in_master")
    violations = j.where(bad).select(F.col(person_col).alias("person_id")).distinct()
    return kept, violations


def person_profile(person: DataFrame, death: DataFrame, excluded: DataFrame) -> DataFrame:
    """What the event domains ask of a person, in one row each: ``_in_master``, birth year and
    month, first death date, ``_excluded``.  One aggregate over the three sources."""
    parts = [
        person.select("person_id", F.lit(True).alias("_in_master"), F.col("year_of_birth").alias("_yob"), F.col("month_of_birth").alias("_mob"),
                      F.lit(None).cast("date").alias("_death_date"), F.lit(False).alias("_excluded")),
        death.select("person_id", F.lit(False).alias("_in_master"), F.lit(None).cast("int").alias("_yob"), F.lit(None).cast("int").alias("_mob"),
                     F.col("death_date").cast("date").alias("_death_date"), F.lit(False).alias("_excluded")),
        excluded.select("person_id", F.lit(False).alias("_in_master"), F.lit(None).cast("int").alias("_yob"), F.lit(None).cast("int").alias("_mob"),
                        F.lit(None).cast("date").alias("_death_date"), F.lit(True).alias("_excluded")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("person_id").isNotNull())
    return rows.groupBy(F.col("person_id").cast("bigint").alias("person_id")).agg(
        F.max("_in_master").alias("_in_master"), F.max("_yob").alias("_yob"), F.max("_mob").alias("_mob"),
        F.min("_death_date").alias("_death_date"), F.max("_excluded").alias("_excluded"))


def with_person_flags(df: DataFrame, profile: DataFrame, *, date_col: str, more: Column, person_col: str = "person_id") -> DataFrame:
    """J1 - J4 from one join, as flags: ``_kept`` (in the master, not excluded, not after the
    death, and ``more``) and ``_violating`` (the same without the master: not in it, without a birth
    year, or born after the event)."""
    p = profile.withColumnRenamed("person_id", "_profile_id")
    j = df.join(p, F.col(person_col).cast("bigint") == p["_profile_id"], "left")
    alive = F.col("_death_date").isNull() | F.coalesce(F.col(date_col).cast("date") <= F.col("_death_date"), F.lit(False))
    stays = alive & ~F.coalesce("_excluded", F.lit(False)) & F.coalesce(more, F.lit(False))
    bad = F.col("_yob").isNull() | F.coalesce(born_after(F.col("_yob"), F.col("_mob"), F.col(date_col).cast("date")), F.lit(False))
    return j.withColumns({"_kept": stays & F.coalesce("_in_master", F.lit(False)), "_violating": stays & bad}).drop(*p.columns)


# ---------------------------------------------------------------- person helpers
def override_sheet(sheet: DataFrame) -> DataFrame:
    """Override rows with a gender concept from the sex label."""
    return sheet.select(integral_long(F.col("person_id")).alias("person_id"),
                        sex_to_gender(F.col("sex")).alias("gender_concept_id"),
                        F.col("year_of_birth").try_cast("int").alias("year_of_birth"),
                        F.col("month_of_birth").try_cast("int").alias("month_of_birth"),
                        F.monotonically_increasing_id().alias("_sheet_row")).where(F.col("person_id").isNotNull())


def apply_person_override(base: DataFrame, overrides: DataFrame, excluded: DataFrame) -> DataFrame:
    """J5 + P14 minus J2: full outer join with the override sheet; sheet values win
    for gender, birth year and month; sheet-only persons are added; excluded
    persons are removed.  ``_sheet_row`` is the sheet's order, null without an entry."""
    if "_sheet_row" not in overrides.columns:
        overrides = overrides.withColumn("_sheet_row", F.lit(0).cast("bigint"))
    o = overrides.select("person_id", "_sheet_row", *[F.col(c).alias(f"_ovr_{c}") for c in
                                        ("gender_concept_id", "year_of_birth", "month_of_birth")])
    m = base.join(o, "person_id", "full_outer")
    m = exclude_persons(m, excluded)
    for c in ("gender_concept_id", "year_of_birth", "month_of_birth"):
        m = m.withColumn(c, F.coalesce(F.col(f"_ovr_{c}"), F.col(c))).drop(f"_ovr_{c}")
    return m


def invalid_person_ids(person: DataFrame) -> DataFrame:
    """F16: birth year null or before 1900."""
    yob = F.col("year_of_birth").cast("string").try_cast("double")
    return person.where(yob.isNull() | (yob < 1900)).select("person_id")


def duplicated_person_ids(df: DataFrame) -> DataFrame:
    """A6 (T4 fixed: applied to the frame before the person dedupe)."""
    return df.groupBy("person_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2).select("person_id")
