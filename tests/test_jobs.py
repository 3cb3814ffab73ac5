"""Folder-level jobs (QC, dedupe, gap export) and the encoded CSV scan."""
import datetime as dt
import os

from clinloom.plans import jobs
from clinloom.schema import select_columns
from clinloom.sources.files import read_table, write_cdm


def _tables(spark, root):
    person = select_columns(spark.createDataFrame([(10000001, 1980), (10000002, None)],
                                                  "person_id long, year_of_birth int"), "person")
    cond = select_columns(spark.createDataFrame(
        [(12401010200001, 10000001, dt.date(2024, 1, 1), 5, "A"), (12401010200002, 10000001, dt.date(2024, 1, 1), 5, "A"),
         (12401010200003, 10000003, dt.date(2024, 1, 2), 0, "B")],
        "condition_occurrence_id long, person_id long, condition_start_date date, condition_concept_id long, "
        "condition_source_value string"), "condition_occurrence")
    write_cdm(person, f"{root}/person")
    write_cdm(cond, f"{root}/condition_occurrence")
    return person, cond


def test_qc_and_dedupe_jobs(spark, tmpdir_path):
    _tables(spark, tmpdir_path)
    report, totals = jobs.qc_job(spark, tmpdir_path)
    rep = {(r.table_name, r.check_name): (r.n, r.severity) for r in report.collect()}
    assert rep[("condition_occurrence", "person_fk")] == (1, "ERROR")
    assert rep[("condition_occurrence", "concept_unmapped")] == (1, "WARN")
    assert totals.collect()[0].n_error >= 1
    counts = {r.table_name: (r.rows_before, r.rows_after, r.removed)
              for r in jobs.dedupe_job(spark, tmpdir_path, f"{tmpdir_path}/dedup").collect()}
    assert counts["condition_occurrence"] == (3, 2, 1)
    assert counts["person"] == (2, 2, 0)


def test_gap_job_exports(spark, tmpdir_path):
    _, cond = _tables(spark, tmpdir_path)
    out = jobs.gap_job(cond, cond.where("condition_source_value = 'A'"), "condition", f"{tmpdir_path}/gap")
    k = out["keys"].collect()[0]
    assert (k.n_both, k.n_only_gen, k.n_only_base) == (1, 1, 0)
    assert os.path.isdir(f"{tmpdir_path}/gap/condition_missing")


def test_encoded_csv(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sheet.csv")
    with open(path, "wb") as fh:
        fh.write("PERSON_ID,sex,name\n10000001,남,홍길동\n".encode("euc-kr"))
    r = read_table(spark, path, encoding="EUC-KR").collect()[0]
    assert (r.sex, r.name) == ("남", "홍길동")


def test_provider_sheet_tsv_export_and_udf_transform(spark, tmpdir_path):
    import pandas as pd
    from pyspark.sql import functions as F

    from clinloom.operators import vocab
    from clinloom.sources.files import read_provider_list, write_tsv
    sheet = spark.createDataFrame([("3", "Ward A", "12", 1), ("3", "Ward B", None, 2)],
                                  "CARE_SITE_ID string, care_site_rawname string, Concept_ID string, n int")
    pl = read_provider_list(sheet, order_col="n")
    assert sorted(((r.care_site_id, r.concept_id) for r in pl.collect()), key=str) == [(3, 12), (3, None)]
    write_tsv(pl, f"{tmpdir_path}/tsv")
    back = spark.read.option("sep", "\t").option("header", "true").csv(f"{tmpdir_path}/tsv")
    assert back.count() == 2

    @F.pandas_udf("string")
    def strip_dash(s: pd.Series) -> pd.Series:  # X1: a user transform plugged in by the caller
        return s.str.replace("-", "", regex=False)

    df = spark.createDataFrame([("A-1",)], "code string")
    assert df.select(vocab.transform_code(F.col("code"), strip_dash).alias("c")).collect()[0].c == "A1"


def test_csv_sides_load_typed(spark, tmpdir_path):
    """A CSV CDM table comes back with its layout types in one text pass;
    an empty string and a null both load as null (plain CSV)."""
    _, cond = _tables(spark, tmpdir_path)
    write_cdm(cond, f"{tmpdir_path}/csv/condition_occurrence.csv", fmt="csv")
    loaded = jobs.load_cdm_table(spark, f"{tmpdir_path}/csv", "condition_occurrence")
    side = jobs.load_side(spark, path=f"{tmpdir_path}/csv/condition_occurrence.csv", cdm_table="condition_occurrence")
    for df in (loaded, side):
        types = dict(df.dtypes)
        assert (types["condition_occurrence_id"], types["condition_start_date"]) == ("bigint", "date")
        got = sorted((r.condition_occurrence_id, r.condition_start_date, r.stop_reason) for r in df.collect())
        assert got == [(12401010200001, dt.date(2024, 1, 1), None), (12401010200002, dt.date(2024, 1, 1), None),
                       (12401010200003, dt.date(2024, 1, 2), None)]
    inferred = jobs.load_side(spark, path=f"{tmpdir_path}/csv/condition_occurrence.csv")
    assert dict(inferred.dtypes)["person_id"] in ("int", "bigint")


def test_note_texts_stay_out_of_the_numbering(spark, monkeypatch):
    """Match and numbering carry no text; each note has its own at the end, whatever its keys repeat."""
    import datetime as dt

    from clinloom.plans import domains
    from clinloom.spec import PipelineSpec, domain

    seen, number = [], domains._number

    def watched(a, *args, **kw):
        seen.append(a.columns)
        return number(a, *args, **kw)

    monkeypatch.setattr(domains, "_number", watched)
    day = dt.date(2024, 1, 5)
    rows = [(10000001, day, dt.datetime(2024, 1, 5, 9, i), "title", "$$$$" + f"text {i} " * 50, 7, 1, 0, i // 2 if i < 4 else None) for i in range(6)]
    rows.append((10000001, day, None, None, None, None, 2, 0, 9))
    source = spark.createDataFrame(rows, "person_id long, note_date date, note_datetime timestamp_ntz, note_title string, note_text string, "
                                         "provider_id long, hosp int, _batch int, _rid long").repartition(3)
    person = spark.createDataFrame([(10000001, 1980, 1)], "person_id long, year_of_birth int, month_of_birth int")
    visit = spark.createDataFrame([(10000001, 77, 9201, day, day, 7)], "person_id long, visit_occurrence_id long, visit_concept_id long, "
                                                                      "visit_start_date date, visit_end_date date, provider_id long")
    ctx = domains.Context(spark, PipelineSpec(domains={}), person, spark.createDataFrame([], "person_id long, death_date date"), visit,
                          spark.createDataFrame([], "person_id long"))
    got = domains.event_build("note", domain("note"), ctx, source)[0].collect()
    assert seen and "note_text" not in seen[0]
    dated = [r for r in got if r.note_datetime]
    assert len(got) == len(dated) + 1 and len({r.note_id for r in got}) == len(got)
    assert {r.visit_occurrence_id for r in dated} == {77} and {r.note_title for r in dated} == {'"title"'}
    assert all(r.note_text == '"' + f"text {r.note_datetime.minute} " * 50 + '"' for r in dated)
    assert [r.note_text for r in got if not r.note_datetime] == [None]
