"""Reading feeds and tables: lenient values, input order, missing paths, text files."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinloom.functions import columns as C
from clinloom.operators import ids, visits, vocab
from clinloom.operators.dedupe import dedupe_natural_key
from clinloom.plans import compare as CMP
from clinloom.plans.domains import measurement_prepare
from clinloom.plans.jobs import load_cdm_table, qc_job
from clinloom.schema import select_columns
from clinloom.sources.batches import compile_batch, load_batches
from clinloom.sources.files import read_supplement, read_table, write_cdm
from clinloom.spec import Batch, domain

D, T = dt.date, dt.datetime


def test_lenient_values(spark):
    df = spark.createDataFrame([("8507.0",), ("12345678",), (" 7 ",), ("9007199254740993",), ("1.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(C.lenient(F.col("v"), "bigint")).collect()] == [8507, 12345678, 7, 9007199254740993, None, None, None]
    day = spark.createDataFrame([("2024-03-01",), ("2024-03-01 10:11:12",), ("2024-13-01",)], "v string")
    assert [r[0] for r in day.select(C.lenient(F.col("v"), "date")).collect()] == [D(2024, 3, 1), D(2024, 3, 1), None]


def test_missing_batches(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError, match="b1"):
        load_batches(spark, domain("condition", (Batch("b1", path=f"{tmpdir_path}/none"),)))
    none = load_batches(spark, domain("condition", (Batch("b1", path=f"{tmpdir_path}/none", optional=True),)))
    assert none.count() == 0 and dict(none.dtypes)["person_id"] == "bigint" and "_batch" in none.columns
    assert load_batches(spark, domain("note")).count() == 0


def test_filter_reaches_the_scan(spark, tmpdir_path):
    df = spark.createDataFrame([(1, D(2024, 1, 1), "x"), (2, D(2020, 1, 1), "y")], "person_id long, visit_start_date date, other string")
    df.write.parquet(f"{tmpdir_path}/v")
    out = compile_batch(spark.read.parquet(f"{tmpdir_path}/v"), Batch("b", options={"date_between": ("2023-01-01", "2024-12-31")}),
                        ["person_id", "visit_start_date"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1 and "GreaterThanOrEqual(visit_start_date" in plan and "other" not in out.columns


def test_ids_follow_batch_then_row(spark, tmpdir_path):
    t = T(2024, 5, 1, 8)
    for b in range(2):
        rows = [(10 * b + i, t, t.date()) for i in range(3)]
        spark.createDataFrame(rows, "person_id long, condition_start_datetime timestamp_ntz, condition_start_date date").coalesce(1).write.parquet(
            f"{tmpdir_path}/b{b}.parquet")
    spec = domain("condition", tuple(Batch(f"b{b}", path=f"{tmpdir_path}/b{b}", hosp=1) for b in range(2)))
    for _ in range(2):
        got = ids.assign_occurrence_id(load_batches(spark, spec), id_col="oid", datetime_col="condition_start_datetime",
                                       date_col="condition_start_date", domain_code="02").orderBy("oid").collect()
        assert [r.person_id for r in got] == [0, 1, 2, 10, 11, 12]


def test_seconds_come_before_splits(spark):
    """A later second in an earlier input split is numbered after an earlier second."""
    rows = [((0 << 33) + i, 0, T(2024, 5, 1, 8, 0, 30 - i), D(2024, 5, 1)) for i in range(5)]
    rows += [((1 << 33) + i, 0, T(2024, 5, 1, 8, 0, 10 + i), D(2024, 5, 1)) for i in range(5)]
    rows += [((2 << 33) + i, 0, T(2024, 5, 1), D(2024, 5, 1)) for i in range(3)]
    df = spark.createDataFrame(rows, "_rid long, _batch int, t timestamp_ntz, d date")
    want = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
    got = ids.number_within_date(df, date_col="d", order_col="t").orderBy("_seq").collect()
    assert [r._rid for r in got] == want and [r._seq for r in got] == list(range(1, 14))


def test_measurement_first_version(spark):
    rows = [(1, D(2024, 1, 2), T(2024, 1, 2), "L1", 1, 1, 0), (1, D(2024, 1, 2), T(2024, 1, 2), "L1", 1, 0, 5)]
    df = spark.createDataFrame(rows, "person_id long, measurement_date date, measurement_time timestamp_ntz, measurement_source_value string, "
                                     "hosp int, _batch int, _rid long")
    assert [(r._batch, r._rid) for r in measurement_prepare(df).collect()] == [(0, 5)]


def test_supplement_last_entry_counts(spark):
    s = read_supplement(spark.createDataFrame([("A", "1.0"), ("B", "2"), ("A", "3"), (None, "4"), ("C", "x")], "c string, i string").coalesce(1))
    assert {(r.code, r.concept_id) for r in s.collect()} == {("A", 3), ("B", 2)}
    rule = vocab.MappingRule("src", "V", "cid", "scid")
    table = spark.createDataFrame([], "source_code string, source_concept_id long, concept_id long, mapped boolean")
    twice = spark.createDataFrame([("A", 3), ("A", 9)], "code string, concept_id long")
    events = spark.createDataFrame([("A",), ("Z",)], "src string")
    assert vocab.apply_standard_mapping(events, table, rule, twice).count() == 2


def test_preceding_visit_of_two_hospitals(spark):
    day = D(2024, 1, 5)
    rows = [(1, 22401050100001, day, day, 1), (1, 12401050100002, day, day, 2), (1, 12401060100001, D(2024, 1, 6), D(2024, 1, 6), 1)]
    vo = spark.createDataFrame(rows, "person_id long, visit_occurrence_id long, visit_start_date date, visit_end_date date, _seq long")
    got = {r.visit_occurrence_id: r.preceding_visit_occurrence_id for r in visits.add_preceding_visit(vo).collect()}
    assert got == {22401050100001: 0, 12401050100002: 22401050100001, 12401060100001: 12401050100002}


def test_open_ended_visit_does_not_blow_up(spark):
    vis = spark.createDataFrame([(1, 7, 9201, D(2024, 1, 1), D(9999, 12, 31), 3), (2, 8, 9201, D(2024, 1, 1), D(2024, 1, 3), 3)],
                                "person_id long, visit_occurrence_id long, visit_concept_id long, visit_start_date date, visit_end_date date, provider_id long")
    ev = spark.createDataFrame([(1, D(2030, 5, 5)), (1, D(2023, 1, 1)), (2, D(2024, 1, 2)), (None, D(2024, 1, 2)), (2, None)], "person_id long, d date")
    bins = ev.select(F.col("person_id").alias("_v_person"), F.lit(3200).cast("long").alias("_v_bin"))
    assert visits._binned_visits(vis, bins, "person_id", 0, 7).count() == 2
    got = {(r.person_id, r.d): r.visit_occurrence_id for r in visits.match_visits(ev, vis, date_col="d").collect()}
    assert got == {(1, D(2030, 5, 5)): 7, (1, D(2023, 1, 1)): None, (2, D(2024, 1, 2)): 8, (None, D(2024, 1, 2)): None, (2, None): None}


def test_csv_keeps_line_breaks_and_spaces(spark, tmpdir_path):
    text = ' "a, b"\nsecond "" line \\ end '
    df = select_columns(spark.createDataFrame([(1, 5, text), (2, 6, None)], "note_id long, person_id long, note_text string"), "note")
    write_cdm(df, f"{tmpdir_path}/note", fmt="csv")
    got = {r.note_id: r.note_text for r in load_cdm_table(spark, tmpdir_path, "note").collect()}
    assert got == {1: text, 2: None}
    write_cdm(df, f"{tmpdir_path}/n.csv", fmt="csv")
    assert read_table(spark, f"{tmpdir_path}/n.csv").count() == 2


def test_qc_of_text_numbers_and_damaged_tables(spark, tmpdir_path):
    with open(f"{tmpdir_path}/person.csv", "w") as f:
        f.write("person_id,gender_concept_id,year_of_birth\n1,8507.0,1980.0\n2,,1990\n")
    got = load_cdm_table(spark, tmpdir_path, "person")
    assert [(r.person_id, r.gender_concept_id, r.year_of_birth) for r in got.orderBy("person_id").collect()] == [(1, 8507, 1980), (2, None, 1990)]
    report, _ = qc_job(spark, tmpdir_path)
    assert report.count() > 0
    import os
    os.makedirs(f"{tmpdir_path}/death")
    with open(f"{tmpdir_path}/death/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="parquet|Parquet|FAILED_READ"):
        load_cdm_table(spark, tmpdir_path, "death").count()


def test_dedupe_of_two_digit_hospitals(spark):
    rows = [(112401050200007, 5, D(2024, 1, 5)), (22401050200003, 5, D(2024, 1, 5)), (32401050200004, 5, D(2024, 1, 5))]
    df = select_columns(spark.createDataFrame(rows, "condition_occurrence_id long, person_id long, condition_start_date date"), "condition_occurrence")
    assert [r.condition_occurrence_id for r in dedupe_natural_key(df, "condition_occurrence").collect()] == [22401050200003]


def test_long_text_dedupe(spark):
    rows = [(12401050900002, 1, D(2024, 1, 5), "t" * 5000), (12401050900001, 1, D(2024, 1, 5), "t" * 5000), (12401050900003, 1, D(2024, 1, 5), None)]
    df = select_columns(spark.createDataFrame(rows, "note_id long, person_id long, note_date date, note_text string"), "note")
    assert sorted((r.note_id, len(r.note_text or "")) for r in dedupe_natural_key(df, "note").collect()) == [(12401050900001, 5000), (12401050900003, 0)]


def test_compare_keys_reads_dates_leniently(spark):
    gen = spark.createDataFrame([(1, "2024-01-05", "A"), (1, "bad", "B")], "person_id long, condition_start_date string, condition_source_value string")
    base = spark.createDataFrame([(1, D(2024, 1, 5), "A")], "person_id long, CONDITION_START_DATE date, condition_source_value string")
    r = CMP.compare_keys(gen, base, CMP.COMPARE_SPEC["condition"][0]).first()
    assert (r.n_both, r.n_only_gen, r.n_only_base) == (1, 1, 0)


def test_first_sheet_entry_of_a_person_stays(spark):
    from clinloom.plans.domains import person_build
    base = spark.createDataFrame([(12345678, 0, 1970)], "person_id long, gender_concept_id long, year_of_birth int").withColumns(
        {c: F.lit(None).cast("bigint") for c in ("month_of_birth", "day_of_birth", "race_concept_id", "ethnicity_concept_id", "location_id")})
    sheet = spark.createDataFrame([("12345678", "여", "1980", "3", "a"), ("12345678", None, "1990", "4", "a")],
                                  "person_id string, sex string, year_of_birth string, month_of_birth string, name string").coalesce(1)
    out = person_build(spark, domain("person", (Batch("b", frame=base, hosp=1),)), sheet)
    r = out["person"].collect()
    assert len(r) == 1 and r[0].year_of_birth == 1980 and r[0].gender_concept_id == 8532
    assert out["duplicated_person_id"].count() == 1


def test_reconcile_job(spark, tmpdir_path):
    from clinloom.plans.jobs import reconcile_job
    cols = "person_id long, condition_start_date date, condition_source_value string, condition_concept_id long"
    gen = spark.createDataFrame([(1, D(2024, 1, 1), "A", 5), (2, D(2024, 1, 2), "A", 5)], cols)
    base = spark.createDataFrame([(1, D(2024, 1, 1), "A", 6)], cols).withColumn("extra", F.lit(1))
    out = reconcile_job(spark, gen, base, "condition", out_dir=f"{tmpdir_path}/r")
    assert set(out) == {"counts", "columns", "keys", "dates", "concepts"}
    assert [tuple(r) for r in out["columns"].collect()] == [("extra", "base")]
    assert {r.key_name: (r.n_both, r.n_gen_only, r.n_base_only) for r in out["keys"].collect()} == {
        "person_id": (1, 1, 0), "condition_source_value": (1, 0, 0)}
    assert out["dates"].first().gen_max == D(2024, 1, 2) and out["concepts"].count() == 2
    assert read_table(spark, f"{tmpdir_path}/r/condition_counts", fmt="csv").count() == 1
