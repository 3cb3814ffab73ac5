"""Plan parameters: batches, domain specs and the pipeline spec (§2.13 table)."""
from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .operators.vocab import MappingRule

FrameSource = DataFrame | Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class Batch:
    """One extraction batch of a feed.

    Either ``path`` (+ ``fmt``: parquet, csv, orc, json; ``None`` picks the first
    existing of parquet/csv, S3) or ``frame`` (a DataFrame or a function of the
    session).  ``hosp`` tags every row (P3).  ``options``: ``int_person_id``,
    ``drop``, ``rename``, ``year_min``, ``date_between``, ``group``.  A path that does not
    exist is an error unless the batch is ``optional``.
    """
    name: str
    path: str | None = None
    fmt: str | None = None
    frame: FrameSource | None = None
    hosp: int | None = None
    options: Mapping[str, Any] = field(default_factory=dict)
    read_options: Mapping[str, str] = field(default_factory=dict)
    optional: bool = False


@dataclass(frozen=True)
class VisitMatch:
    window_pre_days: int = 0
    order_by_diff: bool = False
    null_9203_pass2: bool = False


@dataclass(frozen=True)
class DomainSpec:
    name: str
    domain_code: str = ""
    seq_width: int = 5
    cutoff_year: int = 2026
    batches: tuple[Batch, ...] = ()
    visit_match: VisitMatch = VisitMatch()
    mapping: MappingRule | None = None
    supplement: DataFrame | None = None  # X2: per-domain supplement table (code, concept_id)
    extra: Mapping[str, Any] = field(default_factory=dict)


# Per-domain id code, sequence width, cut-off year and visit-match
# parameters (§2.13).
DEFAULT_DOMAINS: dict[str, dict[str, Any]] = {
    "person": dict(domain_code="00"),
    "death": dict(domain_code="-"),
    "visit": dict(domain_code="01", seq_width=5),
    "condition": dict(domain_code="02", seq_width=5, visit_match=VisitMatch(0, False, False)),
    "drug": dict(domain_code="03", seq_width=5, visit_match=VisitMatch(0, False, True)),
    "procedure": dict(domain_code="04", seq_width=6),
    "measurement": dict(domain_code="05", seq_width=6, visit_match=VisitMatch(7, True, True)),
    "observation": dict(domain_code="06", seq_width=5),
    "note": dict(domain_code="09", seq_width=6, visit_match=VisitMatch(7, True, True),
                 extra={"cutoff_start": "2001-01-01", "cutoff_end": "2025-12-31"}),
}
PAYER_PLAN_CODE, COST_CODE = "07", "08"


def domain(name: str, batches: tuple[Batch, ...] = (), **overrides: Any) -> DomainSpec:
    params = dict(DEFAULT_DOMAINS.get(name, {}))
    params.update(overrides)
    return DomainSpec(name=name, batches=tuple(batches), **params)


@dataclass(frozen=True)
class PipelineSpec:
    domains: Mapping[str, DomainSpec]
    person_id_length: int = 8
    output_root: str | None = None
    output_format: str = "parquet"
    bin_days: int = 7
    visit_salt: int = 1  # tasks at least that share the events of one person and bin in the visit match
    visit_hot_rows: int | None = 1_000_000  # a person and bin of more events is spread over tasks (None: not counted)
    id_method: str = "bucketed"
    # Independent domain builds and table writes submitted at once (Spark runs
    # the jobs side by side; 1 = one after another).
    concurrent_jobs: int = 4
