"""Domain jobs D1-D12: pure functions from DataFrames and a spec to DataFrames.

Person, death and visit have a job each.  The six event domains are declared
(``EVENTS``): what a domain does to its feed, which rows it numbers, which it
keeps afterwards (dropped rows leave gaps in the numbers) and what its table adds.
``event_rows`` runs any of them as one pass: the feed's steps, the visit match, one join with
the person profile (birth, death and exclusion in one row per person), and the numbering,
which writes the rows once.  Rows carry two flags, ``_kept`` and ``_violating``, so the table
and its violation list are two reads of the same files.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cohort, ids, visits, vocab
from ..schema import primary_key, select_columns
from ..sources.batches import load_batches, normalise_columns
from ..sources.files import read_pseudonym_map
from ..spec import DomainSpec, PipelineSpec


@dataclass
class Context:
    """Shared inputs of the event domains."""
    spark: SparkSession
    spec: PipelineSpec
    person: DataFrame
    death: DataFrame
    visit: DataFrame
    excluded: DataFrame
    concept: DataFrame | None = None
    relationship: DataFrame | None = None
    # Streaming (W2/W3): ids continue from ``id_offsets`` (``_d``, ``_issued``) and the
    # per-date count of ids issued by this batch is left in ``issued``.
    id_offsets: DataFrame | None = None
    issued: DataFrame | None = None
    # K5: the frame each domain's mapping rule was applied to (the unmapped report
    # counts rows over exactly this frame).
    mapped_input: dict[str, DataFrame] = field(default_factory=dict)
    profile: DataFrame | None = None  # one row per person; a written table in a pipeline run

    def __post_init__(self) -> None:
        if self.profile is None:
            self.profile = cohort.person_profile(self.person, self.death, self.excluded)


def _number(a: DataFrame, ctx: Context, dom: DomainSpec, *, id_col: str, datetime_col: str,
            date_col: str) -> DataFrame:
    """Batch numbering (W1) or, while streaming, numbering continued from the
    counter offsets in arrival order (W2)."""
    if ctx.id_offsets is None:
        return ids.assign_occurrence_id(a, id_col=id_col, datetime_col=datetime_col, date_col=date_col,
                                        domain_code=dom.domain_code, seq_width=dom.seq_width,
                                        method=ctx.spec.id_method)
    from ..session import materialize
    d = F.col(date_col).cast("date")
    # One micro-batch (bounded by the trigger): materialise it once so the
    # counter, the table and the violation list do not each re-run the upstream.
    a = materialize(a.where(d.isNotNull()))
    ctx.issued = a.groupBy(d.alias("_d")).agg(F.count(F.lit(1)).alias("n"))  # A7: rows per date
    return ids.assign_ids_with_offsets(a, ctx.id_offsets, id_col=id_col, date_col=date_col,
                                       domain_code=dom.domain_code, seq_width=dom.seq_width)


def _map(df: DataFrame, dom: DomainSpec, ctx: Context, feed: DataFrame | None = None) -> DataFrame:
    """Apply the domain's mapping rule when there is one and a vocabulary."""
    if dom.mapping is None or ctx.concept is None:
        return df
    ctx.mapped_input[dom.name] = df
    table = vocab.mapping_table(ctx.concept, ctx.relationship, dom.mapping.vocabulary_id,
                                require_standard=dom.mapping.require_standard)
    return vocab.apply_standard_mapping(df, table, dom.mapping, dom.supplement, feed)


# ---------------------------------------------------------------- D1 person
def person_build(spark: SparkSession, dom: DomainSpec, sheet_raw: DataFrame,
                 pseudonym_raw: DataFrame | None = None) -> dict[str, DataFrame]:
    b = load_batches(spark, dom)
    b = cohort.not_null(b, "person_id")
    first = cohort.first_per_key(b, ["person_id"], ["_batch", "_rid"])  # W9 (T3: location rule is a no-op)
    first = first.withColumn("gender_concept_id",
                             F.when(F.col("gender_concept_id") == 0, F.lit(None)).otherwise(
                                 F.col("gender_concept_id")).cast("bigint"))  # P11
    sheet = normalise_columns(sheet_raw)
    merged = cohort.apply_person_override(first.drop("_batch", "_rid", "hosp"), cohort.override_sheet(sheet),
                                          cohort.excluded_persons(sheet))
    merged = merged.withColumns({
        "gender_source_value": C.gender_to_label(F.col("gender_concept_id")),
        "location_id": F.coalesce(F.col("location_id"), F.lit(0)).cast("bigint"),
        "provider_id": F.lit(0).cast("bigint"), "care_site_id": F.lit(0).cast("bigint"),
        "person_source_value": F.lit(""), "race_source_value": F.lit(""),
        "race_source_concept_id": F.lit(0).cast("bigint"), "ethnicity_source_value": F.lit(""),
        "ethnicity_source_concept_id": F.lit(0).cast("bigint"),
        "birth_datetime": F.lit(None).cast("timestamp_ntz"),
    })
    merged = cohort.not_null(merged, "person_id")
    out: dict[str, DataFrame] = {}
    if pseudonym_raw is not None:
        pm = read_pseudonym_map(pseudonym_raw)
        merged = merged.join(pm, "person_id", "left")
        out["person_m"] = merged.select("person_id", "pid")
    out["duplicated_person_id"] = cohort.duplicated_person_ids(merged)  # T4: before the dedupe
    person = select_columns(cohort.first_per_key(merged, ["person_id"], ["_sheet_row"]), "person")  # sheet order
    out["person"] = person
    out["invalid_person_id"] = cohort.invalid_person_ids(person)
    return out


def person_first_version(spark: SparkSession, dom: DomainSpec) -> DataFrame:
    """W9 alone: earliest batch wins per person."""
    b = cohort.not_null(load_batches(spark, dom), "person_id")
    return cohort.first_per_key(b, ["person_id"], ["_batch", "_rid"])


# ---------------------------------------------------------------- D2 death
def death_build(spark: SparkSession, dom: DomainSpec, person: DataFrame,
                excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    a = load_batches(spark, dom)
    a = cohort.apply_cutoff(a, date_col="death_date", cutoff_year=dom.cutoff_year)
    a = cohort.first_per_key(a, ["person_id"], ["death_date", "_batch", "_rid"])  # W10
    a = cohort.exclude_persons(a, excluded)
    a, invalid = cohort.split_by_person_master(a, person, date_col="death_date")
    a = a.withColumns({c: C.zero_if_null(c) for c in ("cause_concept_id", "cause_source_concept_id")})
    return select_columns(a, "death"), invalid


# ---------------------------------------------------------------- D5 visit
def visit_numbered(spark: SparkSession, dom: DomainSpec, spec: PipelineSpec) -> DataFrame:
    b = load_batches(spark, dom)
    return ids.assign_occurrence_id(b, id_col="visit_occurrence_id", datetime_col="visit_start_time",
                                    date_col="visit_start_date", domain_code=dom.domain_code,
                                    seq_width=dom.seq_width, keep_seq=True, method=spec.id_method)


def visit_build(spark: SparkSession, dom: DomainSpec, ctx_person: DataFrame, death: DataFrame,
                excluded: DataFrame, spec: PipelineSpec, *, sort_by_id: bool = False) -> dict[str, DataFrame]:
    b = visit_numbered(spark, dom, spec)  # W4
    b = b.withColumns({
        "visit_type_concept_id": F.lit(44818518).cast("bigint"),
        "visit_source_concept_id": F.lit(0).cast("bigint"), "visit_source_value": F.lit(""),
        "admitting_source_concept_id": C.admitting_source(F.col("visit_concept_id")),
        "admitting_source_value": F.lit(""), "discharge_to_concept_id": F.lit(0).cast("bigint"),
        "discharge_to_source_value": F.lit(""),
    })
    if spec.person_id_length:
        b = cohort.filter_person_id_length(b, length=spec.person_id_length)
    b = cohort.apply_cutoff(b, date_col="visit_start_date", cutoff_year=dom.cutoff_year)
    b = cohort.remove_after_death(b, death, date_col="visit_start_date")
    b = cohort.exclude_persons(b, excluded)
    b, invalid = cohort.split_by_person_master(b, ctx_person, date_col="visit_start_date")

    vo = b.withColumnsRenamed({"visit_start_time": "visit_start_datetime", "visit_end_time": "visit_end_datetime"})
    vo = visits.add_preceding_visit(vo)
    visit_occurrence = select_columns(vo, "visit_occurrence")
    if sort_by_id:  # O2: optional, only for writing a sorted file (a global range sort)
        visit_occurrence = visit_occurrence.orderBy("visit_occurrence_id")

    start = F.col("visit_start_date")
    ppp = b.select(
        "person_id",
        ids.payer_plan_period_id(F.col("hosp"), start, F.col("_seq"), dom.seq_width).alias("payer_plan_period_id"),
        start.alias("payer_plan_period_start_date"), F.col("visit_end_date").alias("payer_plan_period_end_date"),
        (F.col("payer_source_value") if "payer_source_value" in b.columns else F.lit("")).alias("payer_source_value"),
        (F.col("plan_source_value") if "plan_source_value" in b.columns else F.lit("")).alias("plan_source_value"),
        F.lit("").alias("family_source_value"))
    cost = b.select(
        ids.visit_cost_id(F.col("hosp"), start, F.col("_seq"), dom.seq_width).alias("cost_id"),
        F.col("visit_occurrence_id").alias("cost_event_id"), F.lit("Visit").alias("cost_domain_id"),
        F.lit(0).cast("bigint").alias("cost_type_concept_id"),
        ids.payer_plan_period_id(F.col("hosp"), start, F.col("_seq"), dom.seq_width).alias("payer_plan_period_id"))
    return {"visit_occurrence": visit_occurrence,
            "payer_plan_period": select_columns(ppp, "payer_plan_period"),
            "cost": select_columns(cost, "cost"),
            "invalid_person_id": invalid}


# ---------------------------------------------------------------- D6-D11 event domains
def fixed(*, zero: tuple[str, ...] = (), empty: tuple[str, ...] = (), no_id: tuple[str, ...] = (), no_text: tuple[str, ...] = ()) -> dict[str, Column]:
    """Columns that a table has and no feed gives."""
    kinds = ((zero, F.lit(0).cast("bigint")), (empty, F.lit("")), (no_id, F.lit(None).cast("bigint")), (no_text, F.lit(None).cast("string")))
    return {name: value for names, value in kinds for name in names}


@dataclass(frozen=True)
class EventTable:
    """An event domain: its table and time columns, and what differs between domains.

    ``steps`` act on the feed before the numbering, so rows they drop leave no gap (each gets
    the rows so far and the feed itself).  ``gaps``
    is a condition on numbered rows beside those on the person.  ``adds`` are the table's
    columns that the feed lacks.
    """
    table: str
    date: str
    time: str
    steps: tuple[Callable[["EventTable", DomainSpec, Context, DataFrame, DataFrame], DataFrame], ...]
    adds: Callable[[DataFrame], dict[str, Column]]
    rename: Mapping[str, str] = field(default_factory=dict)
    gaps: Callable[["EventTable", DomainSpec], Column] | None = None
    long_id: bool = False  # F7 in place of F6
    aside: tuple[str, ...] = ()  # long texts that no step reads: they stay out of its sorts

    @property
    def key(self) -> str:
        return primary_key(self.table)


def _concept(df: DataFrame, name: str) -> Column:
    """P10, also for a feed without the column."""
    return C.zero_if_null(name) if name in df.columns else F.lit(0).cast("bigint")


def _detail() -> dict[str, Column]:
    return {"visit_detail_id": F.col("visit_occurrence_id")}  # P16


def _before_cutoff(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    return cohort.apply_cutoff(df, date_col=ev.date, cutoff_year=dom.cutoff_year)


def _of_person(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    return cohort.not_null(df, "person_id")


def _mapped(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    return _map(df, dom, ctx, feed)


def _visited(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    vm = dom.visit_match
    return visits.match_visit_two_pass(df, ctx.visit, date_col=ev.date, window_pre_days=vm.window_pre_days, order_by_diff=vm.order_by_diff,
                                       null_9203_pass2=vm.null_9203_pass2, bin_days=ctx.spec.bin_days, salt=ctx.spec.visit_salt,
                                       hot_rows=ctx.spec.visit_hot_rows, counted=feed)


def _drug_quantity(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    return df.withColumn("quantity", (F.col("quantity_days") * F.col("days_supply")).cast("double"))  # P9


def _first_procedures(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    """F10 and W12."""
    return cohort.first_per_key(cohort.not_null(df, "procedure_datetime"), ["person_id", "procedure_datetime", "procedure_source_value"],
                                ["_batch", "_rid"])


def _inpatient_visited(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    """J9 for the rows of the inpatient group; examinations have no visit."""
    exam = df.where("not _inpatient").withColumns(fixed(no_id=("visit_occurrence_id",)))
    stay = visits.match_visit_single(df.where("_inpatient"), ctx.visit, date_col=ev.date, null_9203=True, bin_days=ctx.spec.bin_days,
                                     salt=ctx.spec.visit_salt, hot_rows=ctx.spec.visit_hot_rows, counted=feed)
    return exam.unionByName(stay, allowMissingColumns=True)


def _in_note_window(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    return cohort.date_window(df, date_col=ev.date, start=dom.extra.get("cutoff_start", "2001-01-01"), end=dom.extra.get("cutoff_end", "2025-12-31"))


def _distinct_results(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    return measurement_prepare(df)


def _first_results(ev: EventTable, dom: DomainSpec, ctx: Context, df: DataFrame, feed: DataFrame) -> DataFrame:
    return cohort.first_per_key(df, MEASUREMENT_DEDUPE_KEY, ids.input_order(df))  # W13


NOTE_TEXT_COLS = ("note_title", "note_text", "note_source_value")
# Columns the measurement feed keeps before numbering.
MEASUREMENT_KEEP = [
    "person_id", "measurement_concept_id", "measurement_date", "measurement_time",
    "measurement_type_concept_id", "operator_concept_id", "value_as_number",
    "value_as_concept_id", "unit_concept_id", "range_low", "range_high", "provider_id",
    "measurement_source_value", "measurement_source_concept_id", "unit_source_value",
    "value_source_value", "hosp",
]
MEASUREMENT_DEDUPE_KEY = ["measurement_date", "measurement_time", "person_id", "measurement_concept_id",
                          "measurement_source_value", "value_as_number"]


def measurement_prepare(src: DataFrame) -> DataFrame:
    """F5, P10, P18, P19, U3 (of equal rows the first in input order stays)."""
    rows = cohort.date_window(src, date_col="measurement_date", start="2001-01-01", end="2025-12-31")
    zeroed = {c: C.zero_if_null(c) for c in ("operator_concept_id", "value_as_concept_id") if c in rows.columns}
    fixed = C.measurement_label_fix(_concept(rows, "measurement_concept_id"), F.col("measurement_source_value"))
    rows = rows.withColumns({**zeroed, "measurement_concept_id": fixed})
    keep = [c for c in MEASUREMENT_KEEP if c in rows.columns]
    return rows.groupBy(*keep).agg(F.min(F.struct(*ids.input_order(rows))).alias("_first")).select(*keep, "_first.*")


EVENTS: dict[str, EventTable] = {
    "condition": EventTable(
        "condition_occurrence", "condition_start_date", "condition_start_datetime",
        (_of_person, _mapped, _visited, _before_cutoff),
        lambda df: {**_detail(), "condition_concept_id": _concept(df, "condition_concept_id"),
                    **fixed(zero=("condition_status_concept_id",), empty=("condition_status_source_value",))}),
    "drug": EventTable(
        "drug_exposure", "drug_exposure_start_date", "drug_exposure_start_datetime",
        (_drug_quantity, _visited, _before_cutoff),
        lambda df: {**_detail(), **fixed(zero=("drug_source_concept_id",), no_text=("lot_number", "sig"), empty=(
            "dose_unit_source_value", "refills", "route_source_value", "stop_reason", "verbatim_end_date"))},
        rename={"conceptid": "drug_concept_id"}),  # P17
    "procedure": EventTable(
        "procedure_occurrence", "procedure_date", "procedure_datetime", (_first_procedures, _mapped),
        lambda df: {"procedure_concept_id": _concept(df, "procedure_concept_id"), **fixed(
            zero=("modifier_concept_id",), empty=("modifier_source_value",), no_id=("visit_occurrence_id", "visit_detail_id"))},
        gaps=lambda ev, dom: cohort.before_year(ev.date, dom.cutoff_year)),
    "observation": EventTable(
        "observation", "observation_date", "observation_time", (_inpatient_visited, _before_cutoff, _of_person),
        lambda df: {**_detail(), "observation_concept_id": C.zero_if_null("observation_concept_id")},
        rename={"observation_time": "observation_datetime"}, long_id=True),
    "note": EventTable(
        "note", "note_date", "note_datetime", (_in_note_window, _visited),
        lambda df: {**_detail(), **{c: C.clean_note_text(c) for c in NOTE_TEXT_COLS if c in df.columns}},  # C13 (T11)
        aside=("note_text",)),
    "measurement": EventTable(
        # An active mapping rule replaces the whole concept column of the prepared rows
        "measurement", "measurement_date", "measurement_time", (_distinct_results, _mapped, _first_results, _visited),
        lambda df: _detail(), rename={"measurement_time": "measurement_datetime"}),
}


def event_feed(name: str, dom: DomainSpec, ctx: Context) -> DataFrame:
    """The domain's batches; those of observations carry their group as a flag."""
    if name != "observation":
        return load_batches(ctx.spark, dom)
    groups = [load_batches(ctx.spark, dom, group=g).withColumn("_inpatient", F.lit(g == "inpatient")) for g in ("inpatient", "exam")]
    return groups[0].unionByName(groups[1], allowMissingColumns=True)


def event_rows(name: str, dom: DomainSpec, ctx: Context, source: DataFrame | None = None) -> DataFrame:
    """All numbered rows of an event domain, with ``_kept`` and ``_violating``.

    Long texts wait in the written feed, and each numbered row gets its own back by the number
    of its row there.  That join hashes the numbered rows, so no task sorts texts."""
    from ..session import materialize
    ev = EVENTS[name]
    rows = source if source is not None else event_feed(name, dom, ctx)
    rows = rows.drop("visit_occurrence_id")
    texts = [c for c in ev.aside if c in rows.columns]
    if texts:
        whole = rows = materialize(rows.withColumns({**{c: v for c, v in ev.adds(rows).items() if c in texts}, "_row": F.monotonically_increasing_id()}))
    feed = rows = rows.drop(*texts)
    for step in ev.steps:
        rows = step(ev, dom, ctx, rows, feed)
    # the conditions of the numbered rows are known before the numbering, which writes them
    width = F.lit(True)
    if ev.long_id:
        width = cohort.longer_id(F.col("person_id"), 1)
    elif ctx.spec.person_id_length:
        width = cohort.id_of_length(F.col("person_id"), ctx.spec.person_id_length)
    more = ev.gaps(ev, dom) if ev.gaps else F.lit(True)
    rows = cohort.with_person_flags(rows, ctx.profile, date_col=ev.date, more=width & more)
    rows = rows.withColumns(ev.adds(rows))
    rows = _number(rows, ctx, dom, id_col=ev.key, datetime_col=ev.time, date_col=ev.date)
    if texts:
        rows = whole.select("_row", *texts).join(rows.hint("shuffle_hash"), "_row").drop("_row")
    return rows.withColumnsRenamed({old: new for old, new in ev.rename.items() if old in rows.columns})


def event_build(name: str, dom: DomainSpec, ctx: Context, source: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(CDM table, violating person ids) of an event domain: two reads of the numbered rows."""
    rows = event_rows(name, dom, ctx, source)
    return (select_columns(rows.where("_kept"), EVENTS[name].table),
            rows.where("_violating").select("person_id").distinct())


def _builder(name: str):
    def build(dom: DomainSpec, ctx: Context, source: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        return event_build(name, dom, ctx, source)
    build.__name__ = f"{name}_build"
    return build


condition_build, drug_build, procedure_build, note_build, measurement_build = map(
    _builder, ("condition", "drug", "procedure", "note", "measurement"))


def observation_build(dom: DomainSpec, ctx: Context, exam: DataFrame | None = None,
                      inpatient: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Of the domain's batches, or of one or both groups given as frames."""
    given = [df.withColumn("_inpatient", F.lit(stay)) for df, stay in ((inpatient, True), (exam, False)) if df is not None]
    source = None
    if given:
        source = given[0] if len(given) == 1 else given[0].unionByName(given[1], allowMissingColumns=True)
    return event_build("observation", dom, ctx, source)


# ---------------------------------------------------------------- D12 lab
def lab_parse(raw: DataFrame, *, site1_keyword: str = "") -> DataFrame:
    """Positional lab export (0 department, 1 person, 5 time, 6 local code,
    8 result, 9 provider, ``code`` from the file name) -> measurement feed."""
    res = F.col("_c8")
    ts = C.lenient(F.col("_c5"), "timestamp_ntz")
    out = raw.select(
        C.hosp_from_department(F.col("_c0"), site1_keyword).alias("hosp"),
        C.integral_long(F.col("_c1")).alias("person_id"),
        F.to_date(ts).alias("measurement_date"), ts.alias("measurement_time"),
        C.strip_whitespace(res).alias("value_source_value"),
        F.col("_c9").alias("provide"), F.col("_c6").alias("localcode"),
        C.lab_operator(res).alias("operator_concept_id"),
        C.lab_qualitative(res).alias("value_as_concept_id"),
        C.lab_value_as_number(res).alias("value_as_number"),
        F.lit(38000277).cast("bigint").alias("measurement_type_concept_id"),
        F.lit(None).cast("double").alias("range_low"), F.lit(None).cast("double").alias("range_high"),
        F.lit(0).cast("bigint").alias("measurement_source_concept_id"),
        F.col("code").alias("measurement_source_value"),
        *([F.col("_rid")] if "_rid" in raw.columns else [F.monotonically_increasing_id().alias("_rid")]))
    return out.where(F.col("value_source_value").isNotNull() & (F.col("value_source_value") != ""))  # F15 (T17)
