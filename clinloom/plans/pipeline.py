"""The whole build in dependency order.

person -> death -> care_site/provider -> visit -> event domains.  The shared
inputs of the event domains (person, death, visit, excluded ids) are
materialised once: written to the output folder when one is given, otherwise
written as Parquet into the shared checkpoint folder.  Either way the event domains
read files instead of re-running the upstream plans, and a lost executor only
recomputes from those files.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from ..operators import cohort, vocab
from ..operators.dedupe import dedupe_natural_key, keep_rule
from ..operators.rollup import care_site_build, provider_build
from ..schema import CDM_TABLES
from ..session import checkpoint_dir, materialize
from ..sources.batches import normalise_columns
from ..sources.files import write_cdm, write_tsv
from ..spec import DomainSpec, PipelineSpec
from . import domains as D

if TYPE_CHECKING:
    from ..streaming.incremental import StreamFeed

ORDER = ["person", "death", "care_site", "provider", "visit", "condition", "procedure", "drug",
         "observation", "note", "measurement"]
EVENT_TABLE = {name: event.table for name, event in D.EVENTS.items()}


def _stage(spark: SparkSession, df: DataFrame, name: str, spec: PipelineSpec) -> DataFrame:
    """Write (and re-read) a shared table, or checkpoint it."""
    if spec.output_root:
        path = f"{spec.output_root}/{name}"
        write_cdm(df, path, fmt="parquet")
        return spark.read.parquet(path)
    return materialize(df)


def build_context(spark: SparkSession, spec: PipelineSpec, sheet_raw: DataFrame, *,
                  concept: DataFrame | None = None, relationship: DataFrame | None = None,
                  pseudonym_raw: DataFrame | None = None) -> tuple[D.Context, dict[str, DataFrame]]:
    """Person, death and visit builds, materialised; returns the event-domain context
    and every table produced so far."""
    out: dict[str, DataFrame] = {}
    missing = [d for d in ("person", "death", "visit") if d not in spec.domains]
    if missing:
        raise ValueError(f"the event domains need the person, death and visit domains; missing: {missing}")
    p = D.person_build(spark, spec.domains["person"], sheet_raw, pseudonym_raw)
    person = _stage(spark, p["person"], "person", spec)
    out.update({"person": person, "invalid_person_id_person": p["invalid_person_id"],
                "duplicated_person_id": p["duplicated_person_id"]})
    if "person_m" in p:
        out["person_m"] = p["person_m"]
    excluded = _stage(spark, cohort.excluded_persons(normalise_columns(sheet_raw)), "_excluded", spec)
    death, dinv = D.death_build(spark, spec.domains["death"], person, excluded)
    death = _stage(spark, death, "death", spec)
    out.update({"death": death, "invalid_person_id_death": dinv})
    v = D.visit_build(spark, spec.domains["visit"], person, death, excluded, spec)
    # The visits used for matching are the deduped, saved ones.
    visit = _stage(spark, dedupe_natural_key(v["visit_occurrence"], "visit_occurrence", keep="lowest"),
                   "visit_occurrence", spec)
    out.update({"visit_occurrence": visit, "payer_plan_period": v["payer_plan_period"], "cost": v["cost"],
                "invalid_person_id_visit": v["invalid_person_id"]})
    profile = _stage(spark, cohort.person_profile(person, death, excluded), "_person_profile", spec)
    return D.Context(spark, spec, person, death, visit, excluded, concept, relationship, profile=profile), out


# K6: the used vocabulary is written as vocabulary files (tab separated, with a header).
VOCABULARY_EXPORT = {"used_concept": "CONCEPT", "used_concept_relationship": "CONCEPT_RELATIONSHIP", "used_vocabulary": "VOCABULARY"}


def run_pipeline(spark: SparkSession, spec: PipelineSpec, sheet_raw: DataFrame, *,
                 domains: Iterable[str] | None = None, provider_list: DataFrame | None = None,
                 pseudonym_raw: DataFrame | None = None, concept: DataFrame | None = None,
                 relationship: DataFrame | None = None, vocabulary: DataFrame | None = None,
                 lab_raw: DataFrame | None = None, site1_keyword: str = "",
                 streams: Mapping[str, StreamFeed] | None = None) -> dict[str, DataFrame]:
    """Build the requested domains (all by default) and return every table.

    Domains in ``streams`` are built from their arriving files, deduped batch by batch, against
    the same person, death and visit tables as the others; what they map counts for the
    unmapped reports and the used vocabulary like a batch build's.  A later run with the same
    ``output_root`` goes on with the files that have arrived since.

    With ``spec.output_root`` each CDM table is deduped on its natural key (K3) and
    written; violation lists and unmapped reports are written too (T24).
    Unknown domains are skipped; event domains need person, death and visit.
    """
    wanted = [d for d in ORDER if domains is None or d in set(domains)]
    used: list[DataFrame] = []
    ctx, out = build_context(spark, spec, sheet_raw, concept=concept, relationship=relationship,
                             pseudonym_raw=pseudonym_raw)
    if provider_list is not None and "care_site" in wanted:
        out["care_site"] = care_site_build(provider_list)
    if provider_list is not None and "provider" in wanted:
        out["provider"] = provider_build(provider_list)

    streams = dict(streams or {})
    stream_root = spec.output_root or f"{checkpoint_dir(spark).rstrip('/')}/streams-{uuid.uuid4().hex}"

    def stream_event(name: str, dom: DomainSpec) -> tuple[dict[str, DataFrame], DataFrame | None]:
        from ..streaming import incremental as inc
        rows, state = f"{stream_root}/_streams/{name}/rows", f"{stream_root}/_streams/{name}/state"
        inc.stream_feed(spark, name, dom, ctx, streams[name], out_dir=rows, state_dir=state)
        res = {EVENT_TABLE[name]: inc.read_output(spark, rows),
               f"invalid_person_id_{name}": spark.read.parquet(f"{state}/invalid").select("person_id").distinct()}
        if dom.mapping is None or concept is None:
            return res, None
        counts = materialize(inc.streamed_codes(spark, state))
        table_map = vocab.mapping_table(concept, relationship, dom.mapping.vocabulary_id, require_standard=dom.mapping.require_standard)
        res[f"{name}_unmapped"] = vocab.unmapped_report(counts, table_map, dom.mapping, dom.supplement)
        return res, vocab.used_concept_ids(counts, table_map, dom.mapping, dom.supplement)

    def build_event(name: str) -> tuple[dict[str, DataFrame], DataFrame | None]:
        res: dict[str, DataFrame] = {}
        dom = spec.domains[name]
        if name in streams:
            return stream_event(name, dom)
        src = None
        if name == "measurement" and lab_raw is not None:
            src = D.lab_parse(lab_raw, site1_keyword=site1_keyword)
        table, invalid = D.event_build(name, dom, ctx, src)
        res[EVENT_TABLE[name]] = table
        res[f"invalid_person_id_{name}"] = invalid
        used_ids = None
        if dom.mapping is not None and concept is not None:
            feed = ctx.mapped_input.get(dom.name)  # the rows at the mapping step
            if feed is None:
                from ..sources.batches import load_batches
                feed = src if src is not None else load_batches(spark, dom)
            table_map = vocab.mapping_table(concept, relationship, dom.mapping.vocabulary_id,
                                            require_standard=dom.mapping.require_standard)
            counts = materialize(vocab.code_counts(feed, dom.mapping))  # a row per code, for the report and the export
            res[f"{name}_unmapped"] = vocab.unmapped_report(counts, table_map, dom.mapping, dom.supplement)
            used_ids = vocab.used_concept_ids(counts, table_map, dom.mapping, dom.supplement)
        return res, used_ids

    events = [n for n in wanted if n in D.EVENTS and n in spec.domains
              and not (n == "measurement" and n not in streams and lab_raw is None and not spec.domains[n].batches)]
    for res, used_ids in _run_all(build_event, events, spec.concurrent_jobs):
        out.update(res)
        if used_ids is not None:
            used.append(used_ids)
    if used and concept is not None:  # K6: vocabulary subsets of the concepts in use
        ids_ = used[0]
        for u in used[1:]:
            ids_ = ids_.unionByName(u)
        ids_ = ids_.distinct()
        out["used_concept"] = vocab.used_concepts(concept, ids_)
        if relationship is not None:
            out["used_concept_relationship"] = vocab.used_relationships(relationship, ids_)
        if vocabulary is not None:
            out["used_vocabulary"] = vocab.used_vocabularies(vocabulary, concept, ids_)
    if spec.output_root:
        def save(item: tuple[str, DataFrame]) -> None:
            name, df = item
            unique = {EVENT_TABLE[n] for n in streams}  # deduped batch by batch
            final = dedupe_natural_key(df, name, keep=keep_rule(name)) if name in CDM_TABLES and name not in unique else df
            if name in VOCABULARY_EXPORT:
                write_tsv(final, f"{spec.output_root}/vocabulary/{VOCABULARY_EXPORT[name]}")
            else:
                write_cdm(final, f"{spec.output_root}/{name}", fmt=spec.output_format)

        todo = [(n, df) for n, df in out.items() if n not in ("person", "death", "visit_occurrence")]  # written
        _run_all(save, todo, spec.concurrent_jobs)
    return out


def _run_all(fn: Callable, items: list, workers: int) -> list:
    """``fn`` over independent items; with ``workers`` > 1 their Spark jobs are
    submitted from that many driver threads at once.  The first failure is raised."""
    if workers <= 1 or len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(fn, items))
