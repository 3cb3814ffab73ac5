"""Golden sample (FIXTURES.md §1-3): CSV / TSV files on disk -> whole pipeline."""
import os

import pytest

from clinloom.operators.vocab import MappingRule
from clinloom.plans.pipeline import run_pipeline
from clinloom.sources.files import read_table, read_vocab_tsv
from clinloom.spec import Batch, PipelineSpec, domain

BOM = "﻿"
FILES = {
    "person/person.csv": "PERSON_ID,gender_concept_id,year_of_birth,month_of_birth,day_of_birth,race_concept_id,"
                         "ethnicity_concept_id,location_id\n12345678,8507,1980,3,1,0,0,0\n23456789,8532,1991,7,15,0,0,0\n",
    "death/death.csv": "PERSON_ID,death_date,death_datetime,death_type_concept_id,cause_concept_id,cause_source_value,"
                       "cause_source_concept_id\n23456789,2023-01-01,2023-01-01 00:00:00,38003569,0,,0\n",
    "visit/visit_occurrence_full.csv":
        "PERSON_ID,visit_concept_id,visit_start_date,visit_start_time,visit_end_date,visit_end_time,provider_id,"
        "care_site_id\n12345678,9201,2020-05-10,2020-05-10 09:00:00,2020-05-12,2020-05-12 10:00:00,7,7\n"
        "23456789,9202,2021-08-01,2021-08-01 13:00:00,2021-08-01,2021-08-01 14:00:00,9,9\n",
    "condition/condition_occurrence.csv":
        "PERSON_ID,condition_start_date,condition_start_datetime,condition_end_date,condition_end_datetime,"
        "condition_type_concept_id,stop_reason,provider_id,condition_source_value\n"
        "12345678,2020-05-11,2020-05-11 09:30:00,,,32020,,7,F32.9\n"
        "12345678,2020-05-11,2020-05-11 09:31:00,,,32020,,7,Z99.9\n"
        "23456789,2021-08-01,2021-08-01 13:30:00,,,32020,,9,R55\n",
    "procedure/procedure.csv":
        "PERSON_ID,procedure_date,procedure_datetime,procedure_type_concept_id,quantity,provider_id,EDI_code,"
        "procedure_source_value\n12345678,2020-05-11,2020-05-11 10:00:00,38000275,1,7,AA100,AA100\n"
        "12345678,2020-05-11,2020-05-11 10:05:00,38000275,1,7,ZZ999,ZZ999\n",
    "sheet.csv": "PERSON_ID,sex,name,year_of_birth,month_of_birth\n99999999,남,삭제,1800,1\n",
}
C_COLS = "concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\tconcept_code\t" \
         "valid_start_date\tvalid_end_date\tinvalid_reason"
CONCEPTS = [("100", "KCD7", "F32.9", ""), ("101", "KCD7", "R55", ""), ("102", "KCD7", "Z99.9", ""),
            ("35489007", "SNOMED", "35489007", "S"), ("271594007", "SNOMED", "271594007", "S"),
            ("2000001", "Korean Revenue Code", "AA100", "S")]
VOCAB = {
    "CONCEPT.csv": C_COLS + "\n" + "\n".join(f"{i}\tname {i}\tDomain\t{v}\tClass\t{s}\t{c}\t19700101\t20991231\t"
                                             for i, v, c, s in CONCEPTS) + "\n",
    "CONCEPT_RELATIONSHIP.csv": "concept_id_1\tconcept_id_2\trelationship_id\tvalid_start_date\tvalid_end_date\t"
                                "invalid_reason\n100\t35489007\tMaps to\t19700101\t20991231\t\n"
                                "101\t271594007\tMaps to\t19700101\t20991231\t\n",
    "VOCABULARY.csv": "vocabulary_id\tvocabulary_name\tvocabulary_reference\tvocabulary_version\t"
                      "vocabulary_concept_id\nKCD7\tKCD7\t\tv\t0\nSNOMED\tSNOMED\t\tv\t0\n"
                      "Korean Revenue Code\tKRC\t\tv\t0\n",
}


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sample"))
    for rel, text in {**FILES, **{f"vocab/{k}": v for k, v in VOCAB.items()}}.items():
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as fh:
            fh.write((BOM if not rel.startswith("vocab") else "") + text)
    cond_rule = MappingRule("condition_source_value", "KCD7", "condition_concept_id", "condition_source_concept_id")
    proc_rule = MappingRule("procedure_source_value", "Korean Revenue Code", "procedure_concept_id",
                            "procedure_source_concept_id")
    spec = PipelineSpec(domains={
        "person": domain("person", (Batch("p", path=f"{root}/person/person"),)),
        "death": domain("death", (Batch("d", path=f"{root}/death/death"),)),
        "visit": domain("visit", (Batch("v", path=f"{root}/visit/visit_occurrence_full", hosp=1),)),
        "condition": domain("condition", (Batch("c", path=f"{root}/condition/condition_occurrence", hosp=1),),
                            mapping=cond_rule),
        "procedure": domain("procedure", (Batch("pr", path=f"{root}/procedure/procedure", hosp=1),),
                            mapping=proc_rule),
    }, output_root=f"{root}/out")
    out = run_pipeline(spark, spec, read_table(spark, f"{root}/sheet.csv"),
                       concept=read_vocab_tsv(spark, f"{root}/vocab/CONCEPT.csv", "concept"),
                       relationship=read_vocab_tsv(spark, f"{root}/vocab/CONCEPT_RELATIONSHIP.csv",
                                                   "concept_relationship"),
                       vocabulary=read_vocab_tsv(spark, f"{root}/vocab/VOCABULARY.csv", "vocabulary"))
    return root, out


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_visit_tables(sample):
    _, out = sample
    assert rows(out["visit_occurrence"], "visit_occurrence_id", "admitting_source_concept_id",
                "preceding_visit_occurrence_id") == [(12005100100001, 38004515, 0), (12108010100001, 0, 0)]
    assert rows(out["payer_plan_period"], "payer_plan_period_id") == [(12005100700001,), (12108010700001,)]
    assert rows(out["cost"], "cost_id", "cost_event_id", "cost_domain_id") == [
        (20051008100001, 12005100100001, "Visit"), (21080108100001, 12108010100001, "Visit")]


def test_condition(sample):
    _, out = sample
    assert rows(out["condition_occurrence"], "condition_occurrence_id", "condition_concept_id",
                "condition_source_concept_id", "visit_occurrence_id") == [
        (12005110200001, 35489007, 100, 12005100100001), (12005110200002, 0, 102, 12005100100001),
        (12108010200001, 271594007, 101, 12108010100001)]


def test_procedure(sample):
    _, out = sample
    assert rows(out["procedure_occurrence"], "procedure_occurrence_id", "procedure_concept_id",
                "procedure_source_concept_id", "visit_occurrence_id") == [
        (120051104000001, 2000001, 2000001, None), (120051104000002, 0, 0, None)]


def test_person_death(sample):
    _, out = sample
    assert rows(out["person"], "person_id", "gender_source_value") == [(12345678, "Male"), (23456789, "Female")]
    assert rows(out["death"], "person_id") == [(23456789,)]


def test_unmapped_and_used_vocab(sample):
    _, out = sample
    assert rows(out["condition_unmapped"], "vocabulary_id", "source_code", "source_concept_id", "concept_id",
                "mapped", "n_rows") == [("KCD7", "Z99.9", 102, 0, False, 1)]
    assert rows(out["procedure_unmapped"], "vocabulary_id", "source_code", "source_concept_id", "concept_id",
                "mapped", "n_rows") == [("Korean Revenue Code", "ZZ999", 0, 0, False, 1)]
    assert len(out["used_concept"].collect()) == 6
    assert len(out["used_concept_relationship"].collect()) == 2
    assert len(out["used_vocabulary"].collect()) == 3


def test_written_outputs(sample, spark):
    root, _ = sample
    assert spark.read.parquet(f"{root}/out/condition_occurrence").count() == 3
    assert spark.read.parquet(f"{root}/out/visit_occurrence").count() == 2


def test_unmapped_counts_rows_at_the_mapping_step(sample, spark):
    """K5: the report counts the rows the mapping saw; a row dropped before it
    (null person) is not counted."""
    root, _ = sample
    extra = os.path.join(root, "condition2", "cond_null.csv")
    os.makedirs(os.path.dirname(extra), exist_ok=True)
    with open(extra, "w", encoding="utf-8") as fh:
        fh.write(FILES["condition/condition_occurrence.csv"].splitlines()[0]
                 + "\n,2020-05-11,2020-05-11 09:32:00,,,32020,,7,Z99.9\n")
    rule = MappingRule("condition_source_value", "KCD7", "condition_concept_id", "condition_source_concept_id")
    spec = PipelineSpec(domains={
        "person": domain("person", (Batch("p", path=f"{root}/person/person"),)),
        "death": domain("death", (Batch("d", path=f"{root}/death/death"),)),
        "visit": domain("visit", (Batch("v", path=f"{root}/visit/visit_occurrence_full", hosp=1),)),
        "condition": domain("condition", (Batch("c", path=f"{root}/condition/condition_occurrence", hosp=1),
                                          Batch("c2", path=f"{root}/condition2/cond_null", hosp=1)),
                            mapping=rule),
    })
    out = run_pipeline(spark, spec, read_table(spark, f"{root}/sheet.csv"),
                       concept=read_vocab_tsv(spark, f"{root}/vocab/CONCEPT.csv", "concept"),
                       relationship=read_vocab_tsv(spark, f"{root}/vocab/CONCEPT_RELATIONSHIP.csv",
                                                   "concept_relationship"))
    assert rows(out["condition_unmapped"], "source_code", "n_rows") == [("Z99.9", 1)]
