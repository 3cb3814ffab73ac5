"""The reference's seven operator unit cases, on Spark DataFrames."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinloom.operators import cohort, ids, visits, vocab

D = dt.date
TS = dt.datetime


@pytest.mark.parametrize("method", ["bucketed", "window"])
def test_occurrence_id(spark, method):
    df = spark.createDataFrame(
        [(1, D(2020, 3, 1), TS(2020, 3, 1, 9), 1), (1, D(2020, 3, 1), TS(2020, 3, 1, 10), 2),
         (2, D(2020, 3, 2), TS(2020, 3, 2, 8), 3)],
        "hosp int, condition_start_date date, condition_start_datetime timestamp_ntz, _rid long")
    out = ids.assign_occurrence_id(df, id_col="cid", datetime_col="condition_start_datetime",
                                   date_col="condition_start_date", domain_code="02", seq_width=5, method=method)
    assert [r.cid for r in out.orderBy("_rid").collect()] == [12003010200001, 12003010200002, 22003020200001]


def test_ids_with_counter_streaming(spark):
    schema = "hosp int, measurement_date date, _rid long"
    c1 = spark.createDataFrame([(1, D(2020, 3, 1), 1), (1, D(2020, 3, 1), 2)], schema)
    c2 = spark.createDataFrame([(1, D(2020, 3, 1), 3), (2, D(2020, 3, 2), 4)], schema)
    empty = spark.createDataFrame([], "_d date, _issued long")
    o1 = ids.assign_ids_with_offsets(c1, empty, id_col="mid", date_col="measurement_date", domain_code="05",
                                     seq_width=6)
    issued = c1.groupBy(F.col("measurement_date").alias("_d")).agg(F.count("*").alias("_issued"))
    o2 = ids.assign_ids_with_offsets(c2, issued, id_col="mid", date_col="measurement_date", domain_code="05",
                                     seq_width=6)
    a = [r.mid for r in o1.orderBy("_rid").collect()]
    b = [r.mid for r in o2.orderBy("_rid").collect()]
    assert a == [120030105000001, 120030105000002]
    assert b[0] == 120030105000003
    assert len(set(a + b)) == 4


def test_person_id_length(spark):
    df = spark.createDataFrame([(10000001,), (123,), (99999999,)], "person_id long")
    assert {r.person_id for r in cohort.filter_person_id_length(df).collect()} == {10000001, 99999999}


def _visits(spark, rows):
    return spark.createDataFrame(rows, "person_id long, visit_occurrence_id long, visit_concept_id long, "
                                       "visit_start_date date, visit_end_date date, provider_id long")


def test_visit_two_pass_provider_priority(spark):
    ev = spark.createDataFrame([(1, 7, D(2020, 1, 5))], "person_id long, provider_id long, condition_start_date date")
    vis = _visits(spark, [(1, 111, 9201, D(2020, 1, 1), D(2020, 1, 10), 99),
                          (1, 222, 9202, D(2020, 1, 1), D(2020, 1, 10), 7)])
    m = visits.match_visit_two_pass(ev, vis, date_col="condition_start_date")
    assert m.collect()[0].visit_occurrence_id == 222


def test_visit_single_9203_null(spark):
    ev = spark.createDataFrame([(1, D(2020, 1, 5))], "person_id long, observation_date date")
    vis = _visits(spark, [(1, 9, 9203, D(2020, 1, 1), D(2020, 1, 10), 1)])
    m = visits.match_visit_single(ev, vis, date_col="observation_date", null_9203=True)
    assert m.collect()[0].visit_occurrence_id is None


def test_remove_after_death_and_master(spark):
    person = spark.createDataFrame([(1, 1980, 1), (2, 1990, 1)], "person_id long, year_of_birth int, month_of_birth int")
    death = spark.createDataFrame([(1, D(2019, 1, 1))], "person_id long, death_date date")
    ev = spark.createDataFrame([(1, D(2020, 1, 5)), (2, D(2020, 1, 5)), (3, D(2020, 1, 5))],
                               "person_id long, condition_start_date date")
    after = cohort.remove_after_death(ev, death, date_col="condition_start_date")
    assert {r.person_id for r in after.collect()} == {2, 3}
    kept = cohort.keep_in_person_master(after, person)
    assert {r.person_id for r in kept.collect()} == {2}


def test_standard_mapping(spark):
    concept = spark.createDataFrame(
        [("100", "x", "Condition", "KCD7", "c", "", "F32.9", "1970", "2099", ""),
         ("9001", "y", "Condition", "SNOMED", "c", "S", "35489007", "1970", "2099", "")],
        ",".join(f"{c} string" for c in ["concept_id", "concept_name", "domain_id", "vocabulary_id",
                                        "concept_class_id", "standard_concept", "concept_code",
                                        "valid_start_date", "valid_end_date", "invalid_reason"]))
    rel = spark.createDataFrame([("100", "9001", "Maps to", "1970", "2099", "")],
                                "concept_id_1 string, concept_id_2 string, relationship_id string, "
                                "valid_start_date string, valid_end_date string, invalid_reason string")
    rule = vocab.MappingRule("condition_source_value", "KCD7", "condition_concept_id", "condition_source_concept_id")
    table = vocab.mapping_table(concept, rel, "KCD7")
    df = spark.createDataFrame([(1, "F32.9"), (2, "ZZZ")], "k int, condition_source_value string")
    out = vocab.apply_standard_mapping(df, table, rule).orderBy("k").collect()
    assert [r.condition_concept_id for r in out] == [9001, 0]
    assert [r.condition_source_concept_id for r in out] == [100, 0]
    rep = vocab.unmapped_report(vocab.code_counts(df, rule), table, rule).collect()
    assert [(r.source_code, r.n_rows, r.mapped) for r in rep] == [("ZZZ", 1, False)]
