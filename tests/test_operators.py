"""Scalar functions, keep-first rules, dedupe, roll-ups, QC and compare operators."""
import datetime as dt
import os

from pyspark.sql import functions as F

from clinloom.functions import columns as C
from clinloom.operators import cohort, dedupe, visits, vocab
from clinloom.operators.rollup import care_site_build
from clinloom.plans import compare as CMP
from clinloom.plans import quality as Q
from clinloom.plans.domains import lab_parse
from clinloom.sources.batches import compile_batch, normalise_columns
from clinloom.sources.files import read_lab_directory, read_supplement
from clinloom.spec import Batch

D = dt.date


def col(spark, values, expr, t="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {t}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_code_transforms(spark):
    assert col(spark, ["A020|x", "R55", "f32.9|y", " a0123 ", None], C.kcd_normalise) == [
        "A02.0", "R55", "F32.9", "A01.23", None]
    assert col(spark, [" AB |c", "x"], C.split_pipe) == ["AB", "x"]


def test_pad_widens(spark):
    assert col(spark, [5, 123456], lambda c: C.pad_widening(c, 5), "long") == ["00005", "123456"]


def test_lab_functions(spark):
    vals = ["12.5", "<3.0", ">7", "(4.5)", "-", "Negative", "Positive 1+", "No WBC", "abc", "nan"]
    assert col(spark, vals, C.lab_operator) == [None, 4171756, 4172704, None, None, None, None, None, None, None]
    assert col(spark, vals, C.lab_qualitative) == [None, None, None, None, 9189, 9189, 9191, None, None, None]
    assert col(spark, vals, C.lab_value_as_number) == [12.5, 3.0, 7.0, 4.5, None, None, None, 0.0, None, None]


def test_note_clean_and_labels(spark):
    assert col(spark, ['a$$$$b""c', "", None], C.clean_note_text) == ['"abc"', "", None]
    assert col(spark, ["남", "여", "x"], C.sex_to_gender) == [8507, 8532, None]
    assert col(spark, [8507, 8532, 0], C.gender_to_label, "long") == ["Male", "Female", ""]
    assert col(spark, [9202, 9201, None], C.admitting_source, "long") == [0, 38004515, 38004515]


def test_id_year_outside_range_fails(spark):
    import pytest
    df = spark.createDataFrame([(D(1999, 5, 1),)], "d date")
    with pytest.raises(Exception):
        df.select(C.yymmdd(F.col("d"))).collect()


def test_batch_options(spark):
    df = spark.createDataFrame([("1", "x", "a", D(2017, 5, 1)), ("2.5", "y", "b", D(2019, 1, 1))],
                               "PERSON_ID string, Code string, junk string, proc_date date")
    df = normalise_columns(df)
    b = Batch("b", hosp=2, options={"int_person_id": True, "drop": ["junk"], "rename": {"code": "src"},
                                    "year_min": 2018})
    out = compile_batch(df, b).collect()
    assert out == []  # 2.5 is not integral; 2017 is before year_min
    b2 = Batch("b", hosp=2, options={"date_between": ["2017-01-01", "2017-12-31"]})
    r = compile_batch(df, b2).collect()
    assert len(r) == 1 and r[0].hosp == 2


def test_first_per_key_collapses_copies(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, None, "z"), (2, 5, "c")], "k int, o int, v string")
    out = sorted((r.k, r.v) for r in cohort.first_per_key(df, ["k"], ["o"]).collect())
    assert out == [(1, "a"), (2, "c")]


def test_preceding_visit_across_buckets(spark):
    vo = spark.createDataFrame(
        [(1, 10, D(2020, 1, 1), D(2020, 1, 3)), (1, 11, D(2020, 3, 5), D(2020, 3, 6)),
         (1, 12, D(2020, 3, 6), D(2020, 3, 8)), (1, 13, D(2020, 3, 7), D(2020, 3, 9)), (2, 20, None, None)],
        "person_id long, visit_occurrence_id long, visit_start_date date, visit_end_date date")
    out = {r.visit_occurrence_id: r.preceding_visit_occurrence_id
           for r in visits.add_preceding_visit(vo, bucket_days=30).collect()}
    # 11 follows 10 across buckets; 12 starts on 11's end day; 13 starts before 12 ends.
    assert out == {10: 0, 11: 10, 12: 11, 13: 0, 20: 0}


def test_visit_window_and_diff(spark):
    ev = spark.createDataFrame([(1, None, D(2020, 1, 5))], "person_id long, provider_id long, d date")
    vis = spark.createDataFrame(
        [(1, 1, 9201, D(2020, 1, 8), D(2020, 1, 20), 3), (1, 2, 9201, D(2020, 1, 1), D(2020, 1, 6), 4),
         (1, 3, 9201, D(2020, 1, 1), D(2020, 1, 6), 4)],
        "person_id long, visit_occurrence_id long, visit_concept_id long, visit_start_date date, "
        "visit_end_date date, provider_id long")
    m = visits.match_visits(ev, vis, date_col="d", window_pre_days=7, order_by_diff=True, bin_days=2)
    assert m.collect()[0].visit_occurrence_id == 2  # 1 day to its end; duplicate 3 removed by W11
    m0 = visits.match_visits(ev, vis, date_col="d", window_pre_days=0, bin_days=2)
    assert m0.count() == 1


def test_natural_key_dedupe_keeps_lowest_sequence(spark):
    from clinloom.schema import select_columns
    df = spark.createDataFrame([(22401010200001, 5), (12401010200002, 5), (12401010200003, 6)],
                               "condition_occurrence_id long, person_id long")
    t = select_columns(df, "condition_occurrence")
    out = sorted(r.condition_occurrence_id for r in dedupe.dedupe_natural_key(t, "condition_occurrence").collect())
    assert out == [12401010200003, 22401010200001]
    again = dedupe.dedupe_natural_key(dedupe.dedupe_natural_key(t, "condition_occurrence"), "condition_occurrence")
    assert again.count() == 2  # idempotent


def test_care_site_rollup(spark):
    pl = spark.createDataFrame([(1, "b", None, 2), (1, "a", 7, 1), (1, "a", 7, 5), (2, "c", None, 3)],
                               "care_site_id long, care_site_rawname string, concept_id long, _ord long")
    out = {r.care_site_id: (r.care_site_name, r.place_of_service_concept_id) for r in care_site_build(pl).collect()}
    assert out == {1: ("a, b", 7), 2: ("c", 0)}


def test_lab_directory_and_parse(spark, tmpdir_path):
    for code, rows in {"L01": ["SITE1 A,10000001,x,x,x,2024-01-02 10:00:00,L01,x,<5,3"],
                       "L02": ["B,10000002,x,x,x,2024-01-03 11:00:00,L02,x,,3",
                               "B,10000002,x,x,x,bad,L02,x,Positive,3"]}.items():
        with open(os.path.join(tmpdir_path, f"{code}.csv"), "w") as fh:
            fh.write("\n".join(rows) + "\n")
    raw = read_lab_directory(spark, tmpdir_path, ["L01", "L02", "L99"])
    out = sorted(lab_parse(raw, site1_keyword="SITE1").drop("_rid").collect(), key=lambda r: r.measurement_source_value)
    assert [(r.hosp, r.measurement_source_value, r.operator_concept_id, r.value_as_number, r.value_as_concept_id)
            for r in out] == [(1, "L01", 4171756, 5.0, None), (2, "L02", None, None, 9191)]
    assert out[1].measurement_date is None  # unparsable time -> null, row kept (F15 only drops empty results)


def test_supplement_rowwise(spark):
    df = spark.createDataFrame([("A", "12"), ("B", "x"), ("C", "30")], "code string, cid string")
    assert sorted((r.code, r.concept_id) for r in read_supplement(df).collect()) == [("A", 12), ("C", 30)]


def test_qc_and_compare(spark):
    person = spark.createDataFrame([(1, 1980), (2, None)], "person_id long, year_of_birth int")
    cond = spark.createDataFrame([(10, 1, D(2020, 1, 1), 5, None), (10, 3, D(1999, 1, 1), 0, 99), (None, 1, None, None, 7)],
                                 "condition_occurrence_id long, person_id long, condition_start_date date, "
                                 "condition_concept_id long, visit_occurrence_id long")
    visit = spark.createDataFrame([(7, 1, D(2020, 1, 1), D(2019, 1, 1))],
                                  "visit_occurrence_id long, person_id long, visit_start_date date, visit_end_date date")
    t = {"person": person, "condition_occurrence": cond, "visit_occurrence": visit}
    pk = {r.table_name: (r.pk_duplicates, r.pk_nulls) for r in Q.qc_pk(t).collect()}
    assert pk["condition_occurrence"] == (1, 1)
    assert {r.table_name: r.person_fk_missing for r in Q.qc_person_fk(t, person).collect()}["condition_occurrence"] == 1
    vfk = Q.qc_visit_fk(t, visit).collect()[0]
    assert (vfk.visit_fk_missing, vfk.visit_non_null) == (1, 2)
    assert Q.qc_mapping_rate(t).collect()[0].mapping_rate == 33.3
    assert Q.qc_start_end(t).collect()[0].start_after_end == 1
    rep = Q.qc_report(t)
    assert Q.qc_totals(rep).collect()[0].n_error >= 3
    keys = CMP.compare_keys(cond, cond.limit(1), ["person_id", "condition_start_date"]).collect()[0]
    assert keys.n_both == 1 and keys.n_only_gen == 2


def test_salted_match_equals_unsalted(spark):
    from clinloom.plans.catalog import context
    from clinloom.sources import derived as dv
    sf = "/root/testdata/sf0.001"
    ctx = context(spark, sf)[1]
    f = dv.condition_feed(spark, sf)
    a = visits.match_visits(f, ctx.visit, date_col="condition_start_date", event_key="_rid", window_pre_days=7)
    b = visits.match_visits(f, ctx.visit, date_col="condition_start_date", event_key="_rid", window_pre_days=7,
                            salt=4, bin_days=3)
    cols = ["_rid", "visit_occurrence_id", "visit_concept_id"]
    assert a.count() == b.count() == f.count()
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0


def test_vocabulary_and_visits_are_not_broadcast(spark):
    """What meets the rows of a build is looked up for the codes in use; sides that grow with the
    input stay out of the driver."""
    concept = spark.createDataFrame([("1", "K1", "KCD7", "S", ""), ("2", "K2", "KCD7", "", ""), ("3", "K3", "KCD7", "", ""), ("4", "K4", "KCD7", "", "")],
                                    "concept_id string, concept_code string, vocabulary_id string, standard_concept string, invalid_reason string")
    edges = spark.createDataFrame([("2", "20", "Maps to", "")], "concept_id_1 string, concept_id_2 string, relationship_id string, invalid_reason string")
    table = vocab.mapping_table(concept, edges, "KCD7")
    assert "Broadcast" not in table._jdf.queryExecution().executedPlan().toString()
    rule = vocab.MappingRule("code", "KCD7", "cid", "src")
    supplement = spark.createDataFrame([("K3", 30), ("K3", 31), ("K9", 90), (None, 5)], "code string, concept_id long").coalesce(1)
    feed = spark.createDataFrame([(1, "K1"), (2, "K2"), (3, "K3"), (4, "K9"), (5, None), (6, "K1"), (7, "no")], "k int, code string")
    want = {(1, 1, 1), (2, 20, 2), (3, 31, 3), (4, 90, 0), (5, 0, 0), (6, 1, 1), (7, 0, 0)}
    for given in (None, feed):
        out = vocab.apply_standard_mapping(feed.where("k < 8"), table, rule, supplement, given)
        assert {(r.k, r.cid, r.src) for r in out.collect()} == want and out.count() == 7
    codes = feed.select(F.col("code").alias("_code"))
    found = vocab.looked_up(codes.distinct(), table.select(F.col("source_code").alias("_code"), "concept_id"), None)
    assert {r._code for r in found.collect()} == {"K1", "K2", "K3"}  # codes without an entry are left out
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "KCD7" not in plan and plan.count("Join") == 1  # the rows meet the written lookup only
    visit = spark.createDataFrame([(1, 7, 9201, "2024-01-01", "9999-12-31", None)], "visit_occurrence_id long, person_id long, visit_concept_id long, "
                                  "visit_start_date string, visit_end_date string, provider_id long")
    visit = visit.withColumns({c: F.col(c).cast("date") for c in ("visit_start_date", "visit_end_date")})
    events = spark.createDataFrame([(1, 7, "2024-05-05"), (2, 8, "2024-05-05"), (3, None, None)], "_rid long, person_id long, d string")
    met = visits.match_visit_two_pass(events.withColumn("d", F.col("d").cast("date")), visit, date_col="d", event_key="_rid")
    assert {(r._rid, r.visit_occurrence_id) for r in met.collect()} == {(1, 1), (2, None), (3, None)}
    joins = [line for line in met._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joins and not any("Broadcast" in line for line in joins)
