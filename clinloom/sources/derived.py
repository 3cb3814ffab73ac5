"""Source feeds derived from the driver's generic tables.

The driver ships TPC-H-like tables plus ``events`` and ``documents``; the clinical
feeds are derived from them with integer arithmetic only, so that the same
definitions can be written in DuckDB SQL for the oracle.  Person ids are
``10_000_000 + key`` (eight digits, the default id length); one event in 97 keeps
the raw short user id so that the id-length rules have rows to drop.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import Batch, DomainSpec, PipelineSpec, domain
from ..operators.vocab import MappingRule

PERSON_OFFSET = 10_000_000
E = F.expr


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pid(key: str) -> Column:
    return (F.lit(PERSON_OFFSET) + F.col(key)).cast("bigint")


def _event_pid() -> Column:
    return E(f"case when event_id % 97 = 5 then user_id else {PERSON_OFFSET} + user_id end").cast("bigint")


def _event_provider() -> Column:
    return E("case when event_id % 11 = 0 then null else event_id % 5 end").cast("bigint")


def _hosp() -> Column:
    return E("1 + event_id % 2").cast("int")


# ---------------------------------------------------------------- person side
def person_batches(spark: SparkSession, sf_dir: str) -> tuple[Batch, ...]:
    c = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 3")

    def base(df: DataFrame) -> DataFrame:
        return df.select(
            _pid("c_custkey").alias("person_id"),
            E("case when c_custkey % 7 = 0 then 0 when c_custkey % 2 = 0 then 8507 else 8532 end")
            .cast("bigint").alias("gender_concept_id"),
            E("case when c_custkey % 17 = 0 then null else 1890 + c_custkey % 150 end").cast("int").alias("year_of_birth"),
            E("1 + c_custkey % 12").cast("int").alias("month_of_birth"),
            E("1 + c_custkey % 28").cast("int").alias("day_of_birth"),
            F.lit(0).cast("bigint").alias("race_concept_id"), F.lit(0).cast("bigint").alias("ethnicity_concept_id"),
            F.col("c_nationkey").cast("bigint").alias("location_id"), F.col("c_custkey").alias("_rid"))

    b1 = base(c.where("c_custkey % 3 <> 0"))
    b2 = base(c.where("c_custkey % 2 = 0")).withColumn("location_id", F.col("location_id") + 100).withColumn(
        "year_of_birth", E("1900 + _rid % 100").cast("int"))
    return (Batch("person_b1", frame=b1, hosp=1), Batch("person_b2", frame=b2, hosp=1))


def override_sheet_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Override / exclusion sheet; rows with ``c_custkey % 55 = 0`` appear twice."""
    c = table(spark, sf_dir, "customer")
    rows = c.where("c_custkey % 11 = 0").unionByName(c.where("c_custkey % 55 = 0"))
    return rows.select(
        _pid("c_custkey").alias("PERSON_ID"),
        E("case when c_custkey % 2 = 0 then '남' else '여' end").alias("sex"),
        E("case when c_custkey % 22 = 0 then concat('삭제', c_name) else c_name end").alias("name"),
        E("case when c_custkey % 22 = 0 then 1800 else 1950 + c_custkey % 40 end").cast("int").alias("year_of_birth"),
        E("1 + c_custkey % 12").cast("int").alias("month_of_birth"))


def pseudonym_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(_pid("c_custkey").alias("PERSON_ID"),
                    E("concat('PID', cast((c_custkey * 7919) % 1000003 as string))").alias("PID"))


def death_batches(spark: SparkSession, sf_dir: str) -> tuple[Batch, ...]:
    c = table(spark, sf_dir, "customer")

    def rows(df: DataFrame, date_expr: str) -> DataFrame:
        d = E(date_expr)
        return df.select(
            _pid("c_custkey").alias("person_id"), d.alias("death_date"),
            d.cast("timestamp_ntz").alias("death_datetime"),
            F.lit(38003569).cast("bigint").alias("death_type_concept_id"),
            E("case when c_custkey % 2 = 0 then null else 4306655 end").cast("bigint").alias("cause_concept_id"),
            E("concat('C', cast(c_custkey % 7 as string))").alias("cause_source_value"),
            F.lit(None).cast("bigint").alias("cause_source_concept_id"), F.col("c_custkey").alias("_rid"))

    b1 = rows(c.where("c_custkey % 9 = 0"),
              "case when c_custkey % 45 = 0 then date'2026-03-01' "
              "else date_add(date'2024-01-10', cast(c_custkey % 20 as int)) end")
    b2 = rows(c.where("c_custkey % 18 = 0"), "date_add(date'2024-01-05', cast(c_custkey % 30 as int))")
    return (Batch("death_b1", frame=b1), Batch("death_b2", frame=b2))


def provider_list_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider sheet from ``supplier``; every fifth supplier is listed twice."""
    s = table(spark, sf_dir, "supplier")
    rows = s.select("*", F.col("s_suppkey").alias("_ord")).unionByName(
        s.where("s_suppkey % 5 = 0").select("*", (F.col("s_suppkey") + 100000).alias("_ord")))
    return rows.select(F.col("s_nationkey").cast("bigint").alias("care_site_id"),
                       F.col("s_name").alias("care_site_rawname"),
                       E("case when s_suppkey % 4 = 0 then null else s_suppkey end").cast("bigint").alias("concept_id"),
                       "_ord")


# ---------------------------------------------------------------- events side
def _events(spark: SparkSession, sf_dir: str, types: tuple[str, ...]) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type").isin(list(types)))


def visit_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, ("view", "signup"))
    return ev.select(
        _event_pid().alias("person_id"),
        E("9201 + event_id % 3").cast("bigint").alias("visit_concept_id"),
        F.to_date("ts").alias("visit_start_date"),
        F.col("ts").cast("timestamp_ntz").alias("visit_start_time"),
        E("date_add(to_date(ts), cast(event_id % 4 as int))").alias("visit_end_date"),
        E("timestampadd(DAY, event_id % 4, ts)").cast("timestamp_ntz").alias("visit_end_time"),
        E("event_id % 5").cast("bigint").alias("provider_id"),
        E("event_id % 25").cast("bigint").alias("care_site_id"),
        E("case when event_id % 2 = 0 then 'NHI' else 'MED' end").alias("payer_source_value"),
        E("concat('PLAN', cast(event_id % 3 as string))").alias("plan_source_value"),
        _hosp().alias("hosp"), F.col("event_id").alias("_rid"))


def visit_batches(spark: SparkSession, sf_dir: str) -> tuple[Batch, ...]:
    v = visit_feed(spark, sf_dir)
    return (Batch("visit_b1", frame=v.where("_rid % 2 = 0"), hosp=1),
            Batch("visit_b2", frame=v.where("_rid % 2 = 1")))


def condition_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, ("click", "purchase", "error"))
    return ev.select(
        _event_pid().alias("person_id"),
        F.to_date("ts").alias("condition_start_date"),
        F.col("ts").cast("timestamp_ntz").alias("condition_start_datetime"),
        F.to_date("ts").alias("condition_end_date"),
        F.col("ts").cast("timestamp_ntz").alias("condition_end_datetime"),
        F.lit(32817).cast("bigint").alias("condition_type_concept_id"),
        E("case when event_id % 4 = 0 then 'stop' end").alias("stop_reason"),
        _event_provider().alias("provider_id"),
        E("concat('A', format_string('%03d', event_id % 40), '|', cast(event_id as string))")
        .alias("condition_source_value"),
        _hosp().alias("hosp"), F.col("event_id").alias("_rid"))


def condition_batches(spark: SparkSession, sf_dir: str) -> tuple[Batch, ...]:
    """Three batches exercising the options: hosp tag; rename + drop; upper-case
    names + date range + minimum year."""
    f = condition_feed(spark, sf_dir)
    b0 = f.where("_rid % 3 = 0")
    b1 = f.where("_rid % 3 = 1").withColumnRenamed("condition_source_value", "diag_code")
    b2 = f.where("_rid % 3 = 2")
    b2 = b2.toDF(*[c if c.startswith("_") else c.upper() for c in b2.columns])
    return (Batch("condition_b1", frame=b0, hosp=1),
            Batch("condition_b2", frame=b1, options={"rename": {"diag_code": "condition_source_value"},
                                                     "drop": ["stop_reason"]}),
            Batch("condition_b3", frame=b2, options={"date_between": ["2024-01-01", "2024-01-25"],
                                                     "year_min": 2024}))


def drug_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, ("purchase",))
    return ev.select(
        _event_pid().alias("person_id"),
        E("case when event_id % 23 = 0 then null else 19000000 + event_id % 50 end").cast("bigint").alias("conceptid"),
        F.to_date("ts").alias("drug_exposure_start_date"),
        F.col("ts").cast("timestamp_ntz").alias("drug_exposure_start_datetime"),
        E("date_add(to_date(ts), cast(event_id % 30 as int))").alias("drug_exposure_end_date"),
        E("timestampadd(DAY, event_id % 30, ts)").cast("timestamp_ntz").alias("drug_exposure_end_datetime"),
        F.lit(38000177).cast("bigint").alias("drug_type_concept_id"),
        E("1 + event_id % 3").cast("int").alias("quantity_days"),
        E("case when event_id % 13 = 0 then null else 1 + event_id % 30 end").cast("int").alias("days_supply"),
        F.lit(4132161).cast("bigint").alias("route_concept_id"),
        _event_provider().alias("provider_id"),
        E("concat('D', format_string('%02d', event_id % 50))").alias("drug_source_value"),
        _hosp().alias("hosp"), F.col("event_id").alias("_rid"))


def procedure_feed(spark: SparkSession, sf_dir: str, *, shift: int = 0) -> DataFrame:
    ev = _events(spark, sf_dir, ("error",))
    return ev.select(
        _event_pid().alias("person_id"),
        E(f"case when event_id % 4 = 0 then null else 2000000 + event_id % 20 + {shift} end")
        .cast("bigint").alias("procedure_concept_id"),
        F.to_date("ts").alias("procedure_date"),
        E("case when event_id % 17 = 0 then null else ts end").cast("timestamp_ntz").alias("procedure_datetime"),
        F.lit(38000275).cast("bigint").alias("procedure_type_concept_id"),
        E("1 + event_id % 2").cast("bigint").alias("quantity"),
        _event_provider().alias("provider_id"),
        E("concat('P', format_string('%02d', event_id % 20))").alias("procedure_source_value"),
        F.lit(0).cast("bigint").alias("procedure_source_concept_id"),
        E("concat('E', cast(event_id % 20 as string))").alias("edi_code"),
        _hosp().alias("hosp"), F.col("event_id").alias("_rid"))


def procedure_batches(spark: SparkSession, sf_dir: str) -> tuple[Batch, ...]:
    """Batch two repeats every tenth procedure (with another concept)."""
    return (Batch("procedure_b1", frame=procedure_feed(spark, sf_dir)),
            Batch("procedure_b2", frame=procedure_feed(spark, sf_dir, shift=1).where("_rid % 10 = 0")))


def observation_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, ("click", "purchase", "error"))
    return ev.select(
        _event_pid().alias("person_id"),
        E("case when event_id % 9 = 0 then null else 4000000 + event_id % 25 end").cast("bigint")
        .alias("observation_concept_id"),
        F.to_date("ts").alias("observation_date"),
        F.col("ts").cast("timestamp_ntz").alias("observation_time"),
        F.lit(38000280).cast("bigint").alias("observation_type_concept_id"),
        F.col("value").cast("double").alias("value_as_number"),
        F.col("event_type").alias("value_as_string"),
        F.lit(0).cast("bigint").alias("value_as_concept_id"),
        F.lit(0).cast("bigint").alias("qualifier_concept_id"),
        F.lit(0).cast("bigint").alias("unit_concept_id"),
        _event_provider().alias("provider_id"),
        E("concat('O', cast(event_id % 25 as string))").alias("observation_source_value"),
        F.lit(0).cast("bigint").alias("observation_source_concept_id"),
        E("1 + (event_id div 2) % 2").cast("int").alias("hosp"),
        F.col("event_id").alias("_rid"))


def observation_batches(spark: SparkSession, sf_dir: str) -> tuple[Batch, ...]:
    f = observation_feed(spark, sf_dir)
    return (Batch("observation_exam", frame=f.where("_rid % 2 = 0"), options={"group": "exam"}),
            Batch("observation_inpatient", frame=f.where("_rid % 2 = 1"), options={"group": "inpatient"}))


def note_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    note_date = E("case when doc_id % 37 = 0 then date'2026-02-01' "
                  "else date_add(date'2024-01-01', cast(doc_id % 30 as int)) end")
    return d.select(
        E(f"{PERSON_OFFSET} + doc_id % 150").cast("bigint").alias("person_id"),
        note_date.alias("note_date"),
        E("timestampadd(MINUTE, doc_id % 600, timestampadd(DAY, doc_id % 30, timestamp_ntz'2024-01-01 08:00:00'))")
        .alias("note_datetime"),
        F.lit(44814637).cast("bigint").alias("note_type_concept_id"),
        F.lit(44814639).cast("bigint").alias("note_class_concept_id"),
        F.col("source").alias("note_title"),
        E("case when doc_id % 5 = 0 then concat('$$$$', text, '\"\"') else text end").alias("note_text"),
        F.lit(32678).cast("bigint").alias("encoding_concept_id"),
        F.lit(0).cast("bigint").alias("language_concept_id"),
        E("doc_id % 5").cast("bigint").alias("provider_id"),
        F.col("lang").alias("note_source_value"),
        E("1 + doc_id % 2").cast("int").alias("hosp"), F.col("doc_id").alias("_rid"))


def lab_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lab export, positional columns ``_c0.._c9`` as text plus the file code."""
    ev = table(spark, sf_dir, "events")
    result = E(
        "case when event_id % 53 = 0 then '' "
        "when event_id % 8 = 0 then concat(format_string('%.2f', value), ' ') "
        "when event_id % 8 = 1 then concat('<', format_string('%.2f', value)) "
        "when event_id % 8 = 2 then concat('>', format_string('%.2f', value)) "
        "when event_id % 8 = 3 then concat('(', format_string('%.2f', value), ')') "
        "when event_id % 8 = 4 then '-' when event_id % 8 = 5 then 'Negative' "
        "when event_id % 8 = 6 then 'Positive' else 'No WBC' end")
    code = E("case when event_id % 12 = 11 then 'MCV' else concat('L', format_string('%02d', event_id % 12)) end")
    return ev.select(
        E("case when event_id % 3 = 0 then 'SITE1 Lab Medicine' else 'SITE2 Lab' end").alias("_c0"),
        _event_pid().cast("string").alias("_c1"),
        F.lit("x").alias("_c2"), F.lit("x").alias("_c3"), F.lit("x").alias("_c4"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("_c5"),
        code.alias("_c6"), F.lit("x").alias("_c7"), result.alias("_c8"),
        E("cast(event_id % 5 as string)").alias("_c9"),
        code.alias("code"), F.col("event_id").alias("_rid"))


# ---------------------------------------------------------------- vocabulary
# Every part row yields one concept per source vocabulary; the id ranges of the
# vocabularies are disjoint (KCD7 1e6 + k, SNOMED 2e6 + k, LOINC 3e6 + k, second
# ``Maps to`` target 4e6 + k, supplement 7e6 + k).
KCD_CODE = "concat('A', format_string('%02d', p_partkey div 10), '.', cast(p_partkey % 10 as string))"


def concept_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")

    def rows(df: DataFrame, cid: str, domain_id: str, vocab: str, cls: str, std: str, code: str,
             invalid: str) -> DataFrame:
        return df.select(E(f"cast({cid} as string)").alias("concept_id"), F.col("p_name").alias("concept_name"),
                         F.lit(domain_id).alias("domain_id"), F.lit(vocab).alias("vocabulary_id"),
                         F.lit(cls).alias("concept_class_id"), E(std).alias("standard_concept"),
                         E(code).alias("concept_code"), F.lit("19700101").alias("valid_start_date"),
                         F.lit("20991231").alias("valid_end_date"), E(invalid).alias("invalid_reason"))

    kcd = rows(p, "1000000 + p_partkey", "Condition", "KCD7", "KCD7 code",
               "case when p_partkey % 7 = 0 then 'S' else '' end", KCD_CODE,
               "case when p_partkey % 13 = 0 then 'D' else '' end")
    snomed = rows(p.where("p_partkey % 3 <> 0"), "2000000 + p_partkey", "Condition", "SNOMED", "Clinical Finding",
                  "'S'", "cast(2000000 + p_partkey as string)", "''")
    loinc = rows(p, "3000000 + p_partkey", "Measurement", "LOINC", "Lab Test",
                 "case when p_partkey % 4 = 3 then '' else 'S' end",
                 "concat('L', format_string('%02d', p_partkey))", "''")
    return kcd.unionByName(snomed).unionByName(loinc)


def relationship_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0")

    def edges(df: DataFrame, c1: str, c2: str, rel: str, invalid: str) -> DataFrame:
        return df.select(E(f"cast({c1} as string)").alias("concept_id_1"), E(f"cast({c2} as string)").alias("concept_id_2"),
                         F.lit(rel).alias("relationship_id"), F.lit("19700101").alias("valid_start_date"),
                         F.lit("20991231").alias("valid_end_date"), E(invalid).alias("invalid_reason"))

    maps = edges(p, "1000000 + p_partkey", "2000000 + p_partkey", "Maps to",
                 "case when p_partkey % 11 = 0 then 'D' else '' end")
    back = edges(p, "2000000 + p_partkey", "1000000 + p_partkey", "Mapped from", "''")
    second = edges(p.where("p_partkey % 8 = 1"), "1000000 + p_partkey", "4000000 + p_partkey", "Maps to", "''")
    return maps.unionByName(back).unionByName(second)


def vocabulary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Fixed rows of the vocabulary table used by the derived concepts.
    rows = [("KCD7", "Korean Classification of Diseases", "", "v7", "44819216"),
            ("SNOMED", "Systematic Nomenclature of Medicine", "", "v2024", "44819097"),
            ("LOINC", "Logical Observation Identifiers Names and Codes", "", "v2.7", "44819102"),
            ("ICD10", "International Classification of Diseases", "", "v2019", "44819124")]
    return spark.createDataFrame(rows, "vocabulary_id string, vocabulary_name string, vocabulary_reference string, "
                                       "vocabulary_version string, vocabulary_concept_id string")


def supplement_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User supplement: KCD7 code -> concept for every part with ``p_partkey % 6 = 3``."""
    p = table(spark, sf_dir, "part").where("p_partkey % 6 = 3")
    return p.select(E(KCD_CODE).alias("code"), E("7000000 + p_partkey").cast("bigint").alias("concept_id"))


CONDITION_RULE = MappingRule("condition_source_value", "KCD7", "condition_concept_id",
                             "condition_source_concept_id", code_transform="kcd7")
MEASUREMENT_RULE = MappingRule("measurement_source_value", "LOINC", "measurement_concept_id",
                               "measurement_source_concept_id")


def pipeline_spec(spark: SparkSession, sf_dir: str, *, supplement: bool = True, **kw) -> PipelineSpec:
    """The whole pipeline over the derived feeds."""
    supp = supplement_table(spark, sf_dir) if supplement else None
    doms = {
        "person": domain("person", person_batches(spark, sf_dir)),
        "death": domain("death", death_batches(spark, sf_dir)),
        "visit": domain("visit", visit_batches(spark, sf_dir)),
        "condition": domain("condition", condition_batches(spark, sf_dir), mapping=CONDITION_RULE, supplement=supp),
        "drug": domain("drug", (Batch("drug_b1", frame=drug_feed(spark, sf_dir)),)),
        "procedure": domain("procedure", procedure_batches(spark, sf_dir)),
        "observation": domain("observation", observation_batches(spark, sf_dir)),
        "note": domain("note", (Batch("note_b1", frame=note_feed(spark, sf_dir)),)),
        "measurement": domain("measurement", (), mapping=MEASUREMENT_RULE),
    }
    return PipelineSpec(domains=doms, **kw)
