"""Registered queries over the driver's tables: name -> f(spark, sf_dir) -> DataFrame.

Each query reads the whole driver tables (through the derived feeds) and runs the
library operators; computed columns carry fixed names that the DuckDB oracle in
``oracle.py`` reproduces.  The shared person / death / visit tables are built
once per (session, folder) and materialised.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cohort, ids, visits, vocab
from ..operators.dedupe import dedupe_counts, dedupe_natural_key
from ..operators.rollup import care_site_build, provider_build
from ..schema import select_columns
from ..sources import derived as dv
from ..sources.batches import load_batches, normalise_columns
from . import compare as CMP
from . import domains as D
from . import quality as Q
from .pipeline import build_context

Query = Callable[[SparkSession, str], DataFrame]
_CTX: dict[tuple[int, str, bool], tuple] = {}


def context(spark: SparkSession, sf: str):
    key = (id(spark), sf, True)
    if key not in _CTX:
        spec = dv.pipeline_spec(spark, sf)
        ctx, out = build_context(spark, spec, dv.override_sheet_raw(spark, sf),
                                 concept=dv.concept_table(spark, sf), relationship=dv.relationship_table(spark, sf),
                                 pseudonym_raw=dv.pseudonym_raw(spark, sf))
        _CTX[key] = (spec, ctx, out)
    return _CTX[key]


def _excluded(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.excluded_persons(normalise_columns(dv.override_sheet_raw(spark, sf)))


def _src(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(F.col("_rid").alias("source_row"), *cols)


# ---------------------------------------------------------------- sources / projections / filters
def q_batch_union(spark, sf):
    spec = dv.pipeline_spec(spark, sf)
    u = load_batches(spark, spec.domains["condition"])
    return u.withColumnsRenamed({"_rid": "source_row", "_batch": "batch_no"})


def q_cdm_projection(spark, sf):
    spec = dv.pipeline_spec(spark, sf)
    v = load_batches(spark, spec.domains["visit"])
    v = v.withColumns({"visit_type_concept_id": F.lit(44818518), "visit_source_concept_id": F.lit(0),
                       "visit_source_value": F.lit(""),
                       "admitting_source_concept_id": C.admitting_source("visit_concept_id"),
                       "admitting_source_value": F.lit(""), "discharge_to_concept_id": F.lit(0),
                       "discharge_to_source_value": F.lit(""),
                       "visit_concept_id": C.zero_if_null("visit_concept_id")})
    v = v.withColumnsRenamed({"visit_start_time": "visit_start_datetime", "visit_end_time": "visit_end_datetime"})
    return select_columns(v, "visit_occurrence")


def q_cutoff_filter(spark, sf):
    spec = dv.pipeline_spec(spark, sf)
    d = cohort.apply_cutoff(load_batches(spark, spec.domains["death"]), date_col="death_date", cutoff_year=2026)
    return d.select("person_id", "death_date", F.col("_batch").alias("batch_no"), F.col("_rid").alias("source_row"))


def q_date_window(spark, sf):
    n = cohort.date_window(dv.note_feed(spark, sf), date_col="note_date", start="2001-01-01", end="2025-12-31")
    return _src(n, "person_id", "note_date")


def q_measurement_window(spark, sf):
    lab = D.lab_parse(dv.lab_raw(spark, sf), site1_keyword="SITE1")
    m = cohort.date_window(lab, date_col="measurement_date", start="2001-01-01", end="2025-12-31")
    return _src(m, "person_id", "measurement_date")


def q_person_id_length(spark, sf):
    return _src(cohort.filter_person_id_length(dv.condition_feed(spark, sf), length=8),
                "person_id", C.id_length("person_id").alias("id_length"))


def q_person_id_longer(spark, sf):
    return _src(cohort.filter_person_id_longer_than(dv.condition_feed(spark, sf), length=1), "person_id")


def q_remove_after_death(spark, sf):
    spec = dv.pipeline_spec(spark, sf)
    death = load_batches(spark, spec.domains["death"])
    return _src(cohort.remove_after_death(dv.condition_feed(spark, sf), death, date_col="condition_start_date"),
                "person_id", "condition_start_date")


def q_exclude_persons(spark, sf):
    return _src(cohort.exclude_persons(dv.condition_feed(spark, sf), _excluded(spark, sf)), "person_id")


def q_keep_in_master(spark, sf):
    _, ctx, _ = context(spark, sf)
    return _src(cohort.keep_in_person_master(dv.condition_feed(spark, sf), ctx.person), "person_id")


def q_validate_person(spark, sf):
    _, ctx, _ = context(spark, sf)
    return cohort.validate_against_person(dv.condition_feed(spark, sf), ctx.person, date_col="condition_start_date")


# ---------------------------------------------------------------- person / death / sites
def q_person_build(spark, sf):
    return context(spark, sf)[2]["person"]


def q_person_first_version(spark, sf):
    spec = dv.pipeline_spec(spark, sf)
    f = D.person_first_version(spark, spec.domains["person"])
    return f.select("person_id", "gender_concept_id", "year_of_birth", "month_of_birth", "location_id",
                    F.col("_batch").alias("batch_no"))


def q_person_override(spark, sf):
    spec = dv.pipeline_spec(spark, sf)
    first = D.person_first_version(spark, spec.domains["person"])
    first = first.withColumn("gender_concept_id", F.when(F.col("gender_concept_id") == 0, F.lit(None))
                             .otherwise(F.col("gender_concept_id")).cast("bigint"))
    sheet = normalise_columns(dv.override_sheet_raw(spark, sf))
    m = cohort.apply_person_override(first, cohort.override_sheet(sheet), cohort.excluded_persons(sheet))
    return m.select("person_id", "gender_concept_id", "year_of_birth", "month_of_birth")


def q_person_pseudonym(spark, sf):
    return context(spark, sf)[2]["person_m"]


def q_person_invalid(spark, sf):
    return context(spark, sf)[2]["invalid_person_id_person"]


def q_person_duplicated(spark, sf):
    return context(spark, sf)[2]["duplicated_person_id"]


def q_death_first(spark, sf):
    return context(spark, sf)[2]["death"]


def q_death_violations(spark, sf):
    return context(spark, sf)[2]["invalid_person_id_death"]


def q_care_site_rollup(spark, sf):
    return care_site_build(dv.provider_list_raw(spark, sf))


def q_provider_rollup(spark, sf):
    return provider_build(dv.provider_list_raw(spark, sf))


# ---------------------------------------------------------------- ids and visits
def q_occurrence_id(spark, sf):
    f = ids.assign_occurrence_id(dv.condition_feed(spark, sf), id_col="condition_occurrence_id",
                                 datetime_col="condition_start_datetime", date_col="condition_start_date",
                                 domain_code="02", seq_width=5)
    return _src(f, "condition_occurrence_id")


def q_visit_build(spark, sf):
    return context(spark, sf)[2]["visit_occurrence"]


def q_payer_plan_period(spark, sf):
    return context(spark, sf)[2]["payer_plan_period"]


def q_visit_cost_rows(spark, sf):
    return context(spark, sf)[2]["cost"]


def q_visit_violations(spark, sf):
    return context(spark, sf)[2]["invalid_person_id_visit"]


def q_preceding_visit(spark, sf):
    return context(spark, sf)[2]["visit_occurrence"].select("visit_occurrence_id", "person_id",
                                                            "preceding_visit_occurrence_id")


def q_visit_lookup_dedupe(spark, sf):
    v = context(spark, sf)[1].visit
    return visits.dedupe_visit_lookup(v)


def _match(spark, sf, **kw):
    ctx = context(spark, sf)[1]
    m = visits.match_visits(dv.condition_feed(spark, sf), ctx.visit, date_col="condition_start_date",
                            event_key="_rid", **kw)
    return _src(m, "visit_occurrence_id", "visit_concept_id")


def q_visit_match_two_pass(spark, sf):
    return _match(spark, sf, window_pre_days=0)


def q_visit_match_window7_diff(spark, sf):
    return _match(spark, sf, window_pre_days=7, order_by_diff=True, null_9203="pass2")


def q_visit_match_single(spark, sf):
    return _match(spark, sf, provider_col=None, null_9203="all")


# ---------------------------------------------------------------- codes and vocabulary
def q_kcd_normalise(spark, sf):
    return _src(dv.condition_feed(spark, sf), C.kcd_normalise("condition_source_value").alias("code"))


def q_split_pipe(spark, sf):
    return _src(dv.condition_feed(spark, sf), C.split_pipe("condition_source_value").alias("code"))


def q_concept_lookup(spark, sf):
    c = vocab.valid_source_concepts(dv.concept_table(spark, sf), "KCD7")
    return c.select("source_code", F.col("cid").alias("source_concept_id"), F.col("std").alias("standard_concept"))


def q_maps_to(spark, sf):
    e = vocab.maps_to_edges(dv.relationship_table(spark, sf))
    return e.select(F.col("c1").alias("concept_id_1"), F.col("tgt").alias("concept_id_2"))


def _kcd_table(spark, sf):
    return vocab.mapping_table(dv.concept_table(spark, sf), dv.relationship_table(spark, sf), "KCD7")


def q_code_mapping(spark, sf):
    return _kcd_table(spark, sf)


def q_standard_mapping(spark, sf):
    m = vocab.apply_standard_mapping(dv.condition_feed(spark, sf), _kcd_table(spark, sf), dv.CONDITION_RULE)
    return _src(m, "condition_concept_id", "condition_source_concept_id")


def q_supplement_fill(spark, sf):
    m = vocab.apply_standard_mapping(dv.condition_feed(spark, sf), _kcd_table(spark, sf), dv.CONDITION_RULE,
                                     dv.supplement_table(spark, sf))
    return _src(m, "condition_concept_id", "condition_source_concept_id")


def q_unmapped_report(spark, sf):
    counts = vocab.code_counts(dv.condition_feed(spark, sf), dv.CONDITION_RULE)
    return vocab.unmapped_report(counts, _kcd_table(spark, sf), dv.CONDITION_RULE,
                                 dv.supplement_table(spark, sf))


def _used(spark, sf):
    counts = vocab.code_counts(dv.condition_feed(spark, sf), dv.CONDITION_RULE)
    return vocab.used_concept_ids(counts, _kcd_table(spark, sf), dv.CONDITION_RULE,
                                  dv.supplement_table(spark, sf))


def q_used_concepts(spark, sf):
    return _used(spark, sf)


def q_used_vocab_concept(spark, sf):
    return vocab.used_concepts(dv.concept_table(spark, sf), _used(spark, sf))


def q_used_vocab_relationship(spark, sf):
    return vocab.used_relationships(dv.relationship_table(spark, sf), _used(spark, sf))


def q_used_vocab_vocabulary(spark, sf):
    return vocab.used_vocabularies(dv.vocabulary_table(spark, sf), dv.concept_table(spark, sf), _used(spark, sf))


# ---------------------------------------------------------------- domain jobs
_BUILT: dict[tuple, tuple[DataFrame, DataFrame]] = {}


def built(spark, sf, name: str, *, supplement: bool = True) -> tuple[DataFrame, DataFrame]:
    """(table, violations) of an event domain, built once per (session, folder) and
    materialised: later queries (QC, compare) read the built table the way the
    pipeline's readers read the written one."""
    from ..session import materialize
    key = (id(spark), sf, name, supplement)
    if key not in _BUILT:
        spec, ctx, _ = context(spark, sf)
        dom = spec.domains[name] if supplement else replace(spec.domains[name], supplement=None)
        lab = D.lab_parse(dv.lab_raw(spark, sf), site1_keyword="SITE1") if name == "measurement" else None
        t, v = D.event_build(name, dom, ctx, lab)
        _BUILT[key] = (materialize(t), v)
    return _BUILT[key]


def _event(name: str, *, supplement: bool = True, part: int = 0):
    def run(spark, sf):
        return built(spark, sf, name, supplement=supplement)[part]
    return run


def q_lab_parse(spark, sf):
    lab = D.lab_parse(dv.lab_raw(spark, sf), site1_keyword="SITE1")
    return lab.withColumnRenamed("_rid", "source_row")


# ---------------------------------------------------------------- dedupe
def _condition_with_copies(spark, sf) -> DataFrame:
    f = dv.condition_feed(spark, sf)
    copies = f.where("_rid % 10 = 0").withColumn("hosp", (3 - F.col("hosp")).cast("int")).withColumn(
        "_rid", F.col("_rid") + 1_000_000_000)
    a = ids.assign_occurrence_id(f.unionByName(copies), id_col="condition_occurrence_id",
                                 datetime_col="condition_start_datetime", date_col="condition_start_date",
                                 domain_code="02", seq_width=5)
    return select_columns(a, "condition_occurrence")


def q_natural_key_dedupe(spark, sf):
    return dedupe_natural_key(_condition_with_copies(spark, sf), "condition_occurrence")


def q_dedupe_counts(spark, sf):
    return dedupe_counts({"condition_occurrence": _condition_with_copies(spark, sf),
                          "visit_occurrence": context(spark, sf)[2]["visit_occurrence"]})


def q_dedupe_job(spark, sf):
    """Written tables deduped into another folder, one of them CSV."""
    from ..sources.files import write_cdm
    from .jobs import dedupe_job
    root = _scratch(spark)
    write_cdm(_condition_with_copies(spark, sf), f"{root}/condition_occurrence", fmt="csv")
    write_cdm(context(spark, sf)[2]["visit_occurrence"], f"{root}/visit_occurrence")
    return dedupe_job(spark, root, f"{root}/deduped")


# ---------------------------------------------------------------- quality
def _qc_tables(spark, sf) -> dict[str, DataFrame]:
    _, _, out = context(spark, sf)
    t = {k: out[k] for k in ("person", "death", "visit_occurrence")}
    t["condition_occurrence"] = built(spark, sf, "condition")[0]
    t["drug_exposure"] = built(spark, sf, "drug")[0]
    t["procedure_occurrence"] = built(spark, sf, "procedure")[0]
    return t


def q_qc_pk(spark, sf):
    return Q.qc_pk(_qc_tables(spark, sf))


def q_qc_person_fk(spark, sf):
    t = _qc_tables(spark, sf)
    return Q.qc_person_fk(t, t["person"])


def q_qc_visit_fk(spark, sf):
    t = _qc_tables(spark, sf)
    return Q.qc_visit_fk(t, t["visit_occurrence"])


def q_qc_mapping_rate(spark, sf):
    return Q.qc_mapping_rate(_qc_tables(spark, sf))


def q_qc_date_range(spark, sf):
    return Q.qc_date_range(_qc_tables(spark, sf))


def q_qc_after_death(spark, sf):
    t = _qc_tables(spark, sf)
    return Q.qc_after_death(t, t["death"])


def q_qc_start_end(spark, sf):
    return Q.qc_start_end(_qc_tables(spark, sf))


def q_qc_report(spark, sf):
    return Q.qc_report(_qc_tables(spark, sf))


def _run_whole(spark, sf, spec, **more) -> None:
    from .pipeline import run_pipeline
    run_pipeline(spark, spec, dv.override_sheet_raw(spark, sf), provider_list=dv.provider_list_raw(spark, sf),
                 pseudonym_raw=dv.pseudonym_raw(spark, sf), concept=dv.concept_table(spark, sf),
                 relationship=dv.relationship_table(spark, sf), vocabulary=dv.vocabulary_table(spark, sf),
                 lab_raw=dv.lab_raw(spark, sf), site1_keyword="SITE1", **more)


def q_pipeline_qc(spark, sf):
    """D13 + K3 + S13 + D14: the whole pipeline written into the shared folder,
    then the QC report over the written tables."""
    from uuid import uuid4

    from ..session import checkpoint_dir
    from .jobs import qc_job
    root = f"{checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    _run_whole(spark, sf, dv.pipeline_spec(spark, sf, output_root=root))
    return qc_job(spark, root)[0]


# ---------------------------------------------------------------- compare / reconcile
def _older(spark, batch):
    feed = batch.frame(spark) if callable(batch.frame) else batch.frame
    return replace(batch, frame=feed.withColumn("condition_source_value", F.concat(F.lit("X"), "condition_source_value")))


def _gen_base(spark, sf) -> tuple[DataFrame, DataFrame]:
    """gen: condition table without the supplement; base: with the supplement, and with
    the codes of the last batch as an older delivery wrote them (a site letter in front)."""
    from ..session import materialize
    key = (id(spark), sf, "gen_base")
    if key not in _BUILT:
        from .pipeline import _run_all
        spec, ctx, _ = context(spark, sf)
        dom = spec.domains["condition"]
        # The two builds are independent: their jobs run side by side.
        gen, base = _run_all(lambda f: f(), [
            lambda: built(spark, sf, "condition", supplement=False)[0],
            lambda: materialize(D.condition_build(replace(dom, batches=(*dom.batches[:2], _older(spark, dom.batches[2]))), ctx)[0])], 2)
        _BUILT[key] = (gen, base)
    return _BUILT[key]


def _comp(spark, sf):
    gen, base = _gen_base(spark, sf)
    return CMP.compare_mapping(gen, base, "condition_source_value", "condition_concept_id")


def q_compare_keys(spark, sf):
    gen, base = _gen_base(spark, sf)
    return CMP.compare_keys(gen, base, CMP.COMPARE_SPEC["condition"][0])


def q_compare_mapping(spark, sf):
    return _comp(spark, sf)


def q_compare_mapping_counts(spark, sf):
    return CMP.compare_mapping_counts(_comp(spark, sf))


def q_gap_missing(spark, sf):
    return CMP.gap_missing(_comp(spark, sf))


def q_gap_common_unmapped(spark, sf):
    return CMP.gap_common_unmapped(_comp(spark, sf))


def q_recon_counts(spark, sf):
    return CMP.recon_counts(*_gen_base(spark, sf))


def q_recon_keys(spark, sf):
    gen, base = _gen_base(spark, sf)
    return CMP.recon_keys(gen, base, ["person_id", "condition_occurrence_id"])


def q_recon_concept_top10(spark, sf):
    gen, base = _gen_base(spark, sf)
    return CMP.recon_concept_top(gen, base, "condition_concept_id", 10)


def q_recon_date_range(spark, sf):
    gen, base = _gen_base(spark, sf)
    return CMP.recon_date_range(gen, base, "condition_start_date")


# ---------------------------------------------------------------- file sinks and scans
def _scratch(spark) -> str:
    """A fresh folder under the shared checkpoint folder."""
    from uuid import uuid4

    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/files-{uuid4().hex}"


def q_vocab_tsv_concept_lookup(spark, sf):
    """K6 -> S6: the concept table exported as TSV, read back as vocabulary text
    (all strings, no quoting) and looked up like ``concept_lookup``."""
    from ..sources.files import read_vocab_tsv, write_tsv
    path = f"{_scratch(spark)}/CONCEPT"
    write_tsv(dv.concept_table(spark, sf), path)
    c = vocab.valid_source_concepts(read_vocab_tsv(spark, path, "concept"), "KCD7")
    return c.select("source_code", F.col("cid").alias("source_concept_id"), F.col("std").alias("standard_concept"))


def q_provider_sheet_csv(spark, sf):
    """K1 (csv) -> S2 + S12: the provider sheet saved as CSV, read by extension,
    normalised and rolled up like ``care_site_rollup``."""
    from ..sources.files import read_provider_list, read_table, write_cdm
    path = f"{_scratch(spark)}/provider_list.csv"
    write_cdm(dv.provider_list_raw(spark, sf), path, fmt="csv")
    return care_site_build(read_provider_list(read_table(spark, path), order_col="_ord"))


def q_supplement_csv_fill(spark, sf):
    """The supplement saved as CSV, parsed row-wise and used like ``supplement_fill``."""
    from ..sources.files import read_supplement, read_table, write_cdm
    path = f"{_scratch(spark)}/supplement.csv"
    write_cdm(dv.supplement_table(spark, sf), path, fmt="csv")
    m = vocab.apply_standard_mapping(dv.condition_feed(spark, sf), _kcd_table(spark, sf), dv.CONDITION_RULE,
                                     read_supplement(read_table(spark, path)))
    return _src(m, "condition_concept_id", "condition_source_concept_id")


def q_condition_csv_load(spark, sf):
    """K1 (csv) -> S13: the built condition table written as CSV and loaded back
    through the QC loader (parquet absent, CSV folder found), typed by the layout."""
    from ..sources.files import write_cdm
    from .jobs import load_cdm_table
    root = _scratch(spark)
    write_cdm(built(spark, sf, "condition")[0], f"{root}/condition_occurrence.csv", fmt="csv")
    return select_columns(load_cdm_table(spark, root, "condition_occurrence"), "condition_occurrence")


# ---------------------------------------------------------------- streaming
def _arrivals(spark, feed: DataFrame, folder: str, steps: int) -> int:
    """Write ``feed`` as the files of ``steps`` arrivals, as many files each as the cluster
    has cores; returns the files of an arrival."""
    each = max(1, spark.sparkContext.defaultParallelism)
    n = steps * each
    feed.repartition(n, F.pmod(F.col("_rid"), F.lit(n))).write.parquet(folder)
    return each


def stream_condition(spark, sf, *, files: int = 4, copies: bool = False, dedupe: bool = False) -> tuple[str, DataFrame]:
    """Stream the condition batches in ``files`` micro-batches and return (folder, output).  With
    ``copies`` every third row arrives again, under another row id and so mostly later."""
    from uuid import uuid4

    from ..session import checkpoint_dir
    from ..streaming.incremental import read_output, stream_domain
    spec, ctx, _ = context(spark, sf)
    dom = spec.domains["condition"]
    base = f"{checkpoint_dir(spark)}/stream-{uuid4().hex}"
    feed = load_batches(spark, dom)
    if copies:
        feed = feed.unionByName(feed.where("_rid % 3 = 0").withColumn("_rid", F.col("_rid") * 7 + 5))
    each = _arrivals(spark, feed, f"{base}/source", files)
    stream_domain(spark, "condition", dom, ctx, source_dir=f"{base}/source", schema=feed.schema,
                  out_dir=f"{base}/out", state_dir=f"{base}/state", max_files_per_trigger=each, dedupe=dedupe)
    return base, read_output(spark, f"{base}/out")


def _streamed(spark, sf) -> tuple[str, DataFrame]:
    key = (id(spark), sf, "stream")
    if key not in _BUILT:
        _BUILT[key] = stream_condition(spark, sf)
    return _BUILT[key]


def q_stream_dedupe_incremental(spark, sf):
    """T-S6 while streaming: each micro-batch leaves out what earlier ones have written."""
    return stream_condition(spark, sf, copies=True, dedupe=True)[1].drop("condition_occurrence_id")


def q_stream_options(spark, sf):
    """T-S1 with batch options: a raw feed with upper-case names, a renamed code column, text ids
    and no hospital is streamed like the typed batches (content without the ids)."""
    from ..spec import Batch
    from ..streaming.incremental import read_output, stream_domain
    spec, ctx, _ = context(spark, sf)
    dom = spec.domains["condition"]
    base = _scratch(spark)
    feed = load_batches(spark, dom).drop("hosp", "_batch").withColumnsRenamed({"condition_source_value": "DX", "provider_id": "PROVIDER_ID"})
    raw = feed.withColumn("PERSON_ID", F.concat(F.col("person_id").cast("string"), F.lit(".0")))
    each = _arrivals(spark, raw, f"{base}/source", 2)
    stream_domain(spark, "condition", dom, ctx, source_dir=f"{base}/source", schema=raw.schema, out_dir=f"{base}/out", state_dir=f"{base}/state",
                  max_files_per_trigger=each, options=Batch("raw", hosp=2, options={"rename": {"dx": "condition_source_value"}, "int_person_id": True}))
    return read_output(spark, f"{base}/out").drop("condition_occurrence_id")


def _observation_feed(spark, sf, base: str):
    from ..streaming.incremental import StreamFeed
    dom = context(spark, sf)[0].domains["observation"]
    groups = {g: load_batches(spark, dom, group=g) for g in ("exam", "inpatient")}
    each = [_arrivals(spark, df, f"{base}/{g}", 2) for g, df in groups.items()]
    return StreamFeed({g: f"{base}/{g}" for g in groups}, groups["exam"].schema, max_files_per_trigger=each[0])


def q_stream_observation(spark, sf):
    """T-S4: examinations, then inpatient rows, as two streams sharing one counter: content
    without the ids, and whether the ids are unique over both."""
    from ..streaming.incremental import read_output, stream_feed
    spec, ctx, _ = context(spark, sf)
    base = _scratch(spark)
    stream_feed(spark, "observation", spec.domains["observation"], ctx, _observation_feed(spark, sf, base),
                out_dir=f"{base}/out", state_dir=f"{base}/state", dedupe=False)
    out = read_output(spark, f"{base}/out")
    again = out.groupBy("observation_id").agg(F.count("*").alias("times"))
    return out.join(again, "observation_id").withColumn("unique_id", F.col("times") == 1).drop("observation_id", "times")


def q_pipeline_streamed(spark, sf):
    """D13 with two streamed domains beside the batch ones: condition arrives in four
    micro-batches (a third of its rows twice) and observation as two streams; the QC report over the
    written tables."""
    from ..streaming.incremental import StreamFeed
    from .jobs import qc_job
    base = _scratch(spark)
    spec = dv.pipeline_spec(spark, sf, output_root=f"{base}/cdm")
    feed = load_batches(spark, spec.domains["condition"])
    feed = feed.unionByName(feed.where("_rid % 3 = 0").withColumn("_rid", F.col("_rid") * 7 + 5))
    each = _arrivals(spark, feed, f"{base}/condition", 4)
    streams = {"condition": StreamFeed(f"{base}/condition", feed.schema, max_files_per_trigger=each),
               "observation": _observation_feed(spark, sf, f"{base}/observation")}
    _run_whole(spark, sf, spec, streams=streams)
    return qc_job(spark, f"{base}/cdm")[0]


def q_stream_ids(spark, sf):
    """Streamed condition build; ids are numbered by arrival (T27), so the content is
    compared without the id (see ``stream_id_check``)."""
    return _streamed(spark, sf)[1].drop("condition_occurrence_id")


def q_stream_id_check(spark, sf):
    """Per date rows, distinct ids, and whether all sequences lie in 1..issued."""
    from ..operators.dedupe import sequence_of
    from ..streaming.incremental import issued_per_date
    base, out = _streamed(spark, sf)
    per_date = out.withColumn("seq", sequence_of("condition_occurrence")).groupBy(F.col("condition_start_date").alias("event_date")).agg(
        F.count("*").alias("n_rows"), F.count_distinct("condition_occurrence_id").alias("n_ids"),
        F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    return per_date.join(issued_per_date(spark, f"{base}/state"), "event_date").select(
        "event_date", "n_rows", "n_ids", "issued", ((F.col("lo") >= 1) & (F.col("hi") <= F.col("issued"))).alias("in_range"))


def q_stream_unmapped(spark, sf):
    """K5 while streaming."""
    from ..streaming.incremental import stream_unmapped
    spec, ctx, _ = context(spark, sf)
    return stream_unmapped(spark, f"{_streamed(spark, sf)[0]}/state", spec.domains["condition"], ctx)


def q_stream_dedupe(spark, sf):
    """T-S6: the natural-key dedupe after the stream (content without the ids)."""
    from ..streaming.incremental import finalize
    return finalize(spark, f"{_streamed(spark, sf)[0]}/out", "condition_occurrence").drop("condition_occurrence_id")


# ---------------------------------------------------------------- feeds from text files
def q_csv_feed_text_ids(spark, sf):
    """A CSV feed whose integers are written ``N.0``, with empty providers and
    a batch option for integer persons; read like the typed feed."""
    from ..sources.files import write_cdm
    from ..spec import Batch, domain
    feed = dv.condition_feed(spark, sf)
    text = feed.withColumns({c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("person_id", "provider_id", "hosp")})
    path = f"{_scratch(spark)}/condition"
    write_cdm(text, path, fmt="csv")
    b = load_batches(spark, domain("condition", (Batch("csv", path=path, fmt="csv", options={"int_person_id": True}),)))
    return _src(b, "person_id", "provider_id", "hosp", "condition_start_date", "condition_start_datetime", "condition_source_value")


def q_note_csv_load(spark, sf):
    """K1 (csv) -> S13: notes with line breaks and quotes written as CSV and loaded back."""
    from ..sources.files import write_cdm
    from .jobs import load_cdm_table
    root = _scratch(spark)
    write_cdm(built(spark, sf, "note")[0], f"{root}/note", fmt="csv")
    return select_columns(load_cdm_table(spark, root, "note"), "note")


def q_supplement_repeated_code(spark, sf):
    """An older entry in front of every code; the last one counts, rows stay."""
    from ..sources.files import read_supplement
    now = dv.supplement_table(spark, sf)
    old = now.withColumn("concept_id", F.col("concept_id") + 500_000)
    m = vocab.apply_standard_mapping(dv.condition_feed(spark, sf), _kcd_table(spark, sf), dv.CONDITION_RULE,
                                     read_supplement(old.unionByName(now)))
    return _src(m, "condition_concept_id", "condition_source_concept_id")


def q_visit_match_open_ended(spark, sf):
    """Every fifth visit without an end (9999-12-31), which no bin table may spell out."""
    _, ctx, _ = context(spark, sf)
    open_end = F.when(F.col("visit_occurrence_id") % 5 == 0, F.lit("9999-12-31").cast("date")).otherwise(F.col("visit_end_date"))
    m = visits.match_visit_two_pass(dv.condition_feed(spark, sf), ctx.visit.withColumn("visit_end_date", open_end),
                                    date_col="condition_start_date", event_key="_rid")
    return _src(m, "visit_occurrence_id", "visit_concept_id")


def q_visit_match_salted(spark, sf):
    """J8 with each (person, bin) spread over four tasks, and events without a person."""
    _, ctx, _ = context(spark, sf)
    feed = dv.condition_feed(spark, sf).withColumn("person_id", F.when(F.col("_rid") % 3 != 0, F.col("person_id")))
    m = visits.match_visit_two_pass(feed, ctx.visit, date_col="condition_start_date", event_key="_rid", salt=4)
    return _src(m, "visit_occurrence_id", "visit_concept_id")


def q_visit_sorted_file(spark, sf):
    """O2: visits written in id order and read back: each row behind a smaller id of its file, or first
    in a file whose ids all lie behind those of the file before."""
    from pyspark.sql import Window
    spec, ctx, _ = context(spark, sf)
    v = D.visit_build(spark, spec.domains["visit"], ctx.person, ctx.death, ctx.excluded, spec, sort_by_id=True)["visit_occurrence"]
    path = f"{_scratch(spark)}/visit_occurrence"
    v.write.parquet(path)
    rows = spark.read.parquet(path).select("visit_occurrence_id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    files = rows.groupBy("file").agg(F.min("visit_occurrence_id").alias("lo"), F.max("visit_occurrence_id").alias("hi"))
    files = files.select("file", F.coalesce(F.lag("hi").over(Window.orderBy("file")) < F.col("lo"), F.lit(True)).alias("behind"))  # a row a file
    before = F.lag("visit_occurrence_id").over(Window.partitionBy("file").orderBy("at"))
    return rows.withColumn("before", before).join(files, "file").select(
        "visit_occurrence_id", F.coalesce(F.col("before") < F.col("visit_occurrence_id"), F.col("behind")).alias("in_order"))


def q_gap_export_csv(spark, sf):
    """K7: the gap tables exported as CSV; the missing codes read back."""
    from .jobs import gap_job
    root = _scratch(spark)
    missing = gap_job(*_gen_base(spark, sf), "condition", out_dir=root)["missing"]
    back = spark.read.option("header", "true").csv(f"{root}/condition_missing")
    return back.select(*(F.col(f.name).cast(f.dataType) for f in missing.schema))


def q_exclusion_sheet_csv(spark, sf):
    """The override and exclusion sheet saved as CSV, scanned, and the excluded persons taken."""
    from ..sources.files import read_table, write_cdm
    path = f"{_scratch(spark)}/sheet"
    write_cdm(dv.override_sheet_raw(spark, sf), path, fmt="csv")
    return cohort.excluded_persons(normalise_columns(read_table(spark, path, fmt="csv")))


def q_batch_format_fallback(spark, sf):
    """S3: a batch path without a format of which only the CSV form exists."""
    from ..sources.files import write_cdm
    from ..spec import Batch, domain
    path = f"{_scratch(spark)}/condition"
    write_cdm(dv.condition_feed(spark, sf), f"{path}.csv", fmt="csv")
    b = load_batches(spark, domain("condition", (Batch("b", path=path),)))
    return _src(b, "person_id", "provider_id", "hosp", "condition_start_date", "condition_start_datetime", "condition_source_value")


def _one_person(spark, sf) -> DataFrame:
    """The condition feed with a third of its rows given to the person of the first row."""
    feed = dv.condition_feed(spark, sf)
    hot = feed.where(F.col("person_id").isNotNull()).select("person_id", "_rid").orderBy("_rid").limit(1).first().person_id
    return feed.withColumn("person_id", F.when(F.col("_rid") % 3 == 1, F.lit(hot)).otherwise(F.col("person_id")))


def q_visit_match_hot_person(spark, sf):
    """J8 with a third of all events on one person and bins of a year: cells of more than a
    hundred events are spread, the others stay whole."""
    _, ctx, _ = context(spark, sf)
    m = visits.match_visit_two_pass(_one_person(spark, sf), ctx.visit, date_col="condition_start_date", event_key="_rid",
                                    bin_days=365, hot_rows=100)
    return _src(m, "visit_occurrence_id", "visit_concept_id")


def q_qc_totals(spark, sf):
    return Q.qc_totals(q_qc_report(spark, sf))


QUERIES: dict[str, Query] = {
    "batch_union": q_batch_union,
    "cdm_projection": q_cdm_projection,
    "cutoff_filter": q_cutoff_filter,
    "date_window": q_date_window,
    "measurement_window": q_measurement_window,
    "person_id_length": q_person_id_length,
    "person_id_longer": q_person_id_longer,
    "remove_after_death": q_remove_after_death,
    "exclude_persons": q_exclude_persons,
    "keep_in_master": q_keep_in_master,
    "validate_person": q_validate_person,
    "person_build": q_person_build,
    "person_first_version": q_person_first_version,
    "person_override": q_person_override,
    "person_pseudonym": q_person_pseudonym,
    "person_invalid": q_person_invalid,
    "person_duplicated": q_person_duplicated,
    "death_first": q_death_first,
    "death_violations": q_death_violations,
    "care_site_rollup": q_care_site_rollup,
    "provider_rollup": q_provider_rollup,
    "occurrence_id": q_occurrence_id,
    "visit_build": q_visit_build,
    "payer_plan_period": q_payer_plan_period,
    "visit_cost_rows": q_visit_cost_rows,
    "visit_violations": q_visit_violations,
    "preceding_visit": q_preceding_visit,
    "visit_lookup_dedupe": q_visit_lookup_dedupe,
    "visit_match_two_pass": q_visit_match_two_pass,
    "visit_match_window7_diff": q_visit_match_window7_diff,
    "visit_match_single": q_visit_match_single,
    "kcd_normalise": q_kcd_normalise,
    "split_pipe": q_split_pipe,
    "concept_lookup": q_concept_lookup,
    "maps_to": q_maps_to,
    "code_mapping": q_code_mapping,
    "standard_mapping": q_standard_mapping,
    "supplement_fill": q_supplement_fill,
    "unmapped_report": q_unmapped_report,
    "used_concepts": q_used_concepts,
    "used_vocab_concept": q_used_vocab_concept,
    "used_vocab_relationship": q_used_vocab_relationship,
    "used_vocab_vocabulary": q_used_vocab_vocabulary,
    "condition_build": _event("condition"),
    "condition_violations": _event("condition", part=1),
    "drug_build": _event("drug"),
    "procedure_build": _event("procedure"),
    "observation_build": _event("observation"),
    "note_build": _event("note"),
    "measurement_build": _event("measurement"),
    "lab_parse": q_lab_parse,
    "natural_key_dedupe": q_natural_key_dedupe,
    "dedupe_counts": q_dedupe_counts,
    "dedupe_job": q_dedupe_job,
    "qc_pk": q_qc_pk,
    "qc_person_fk": q_qc_person_fk,
    "qc_visit_fk": q_qc_visit_fk,
    "qc_mapping_rate": q_qc_mapping_rate,
    "qc_date_range": q_qc_date_range,
    "qc_after_death": q_qc_after_death,
    "qc_start_end": q_qc_start_end,
    "qc_report": q_qc_report,
    "pipeline_qc": q_pipeline_qc,
    "compare_keys": q_compare_keys,
    "compare_mapping": q_compare_mapping,
    "compare_mapping_counts": q_compare_mapping_counts,
    "gap_missing": q_gap_missing,
    "gap_common_unmapped": q_gap_common_unmapped,
    "recon_counts": q_recon_counts,
    "recon_keys": q_recon_keys,
    "recon_concept_top10": q_recon_concept_top10,
    "recon_date_range": q_recon_date_range,
    "stream_ids": q_stream_ids,
    "stream_id_check": q_stream_id_check,
    "stream_unmapped": q_stream_unmapped,
    "stream_dedupe": q_stream_dedupe,
    "csv_feed_text_ids": q_csv_feed_text_ids,
    "note_csv_load": q_note_csv_load,
    "supplement_repeated_code": q_supplement_repeated_code,
    "visit_match_open_ended": q_visit_match_open_ended,
    "visit_match_salted": q_visit_match_salted,
    "visit_match_hot_person": q_visit_match_hot_person,
    "visit_sorted_file": q_visit_sorted_file,
    "gap_export_csv": q_gap_export_csv,
    "exclusion_sheet_csv": q_exclusion_sheet_csv,
    "batch_format_fallback": q_batch_format_fallback,
    "stream_dedupe_incremental": q_stream_dedupe_incremental,
    "stream_options": q_stream_options,
    "stream_observation": q_stream_observation,
    "pipeline_streamed": q_pipeline_streamed,
    "qc_totals": q_qc_totals,
    "vocab_tsv_concept_lookup": q_vocab_tsv_concept_lookup,
    "provider_sheet_csv": q_provider_sheet_csv,
    "supplement_csv_fill": q_supplement_csv_fill,
    "condition_csv_load": q_condition_csv_load,
}
