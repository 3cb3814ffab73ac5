"""Incremental build on Structured Streaming (T-S1 ... T-S7, W2).

A file stream of a feed is processed micro-batch by micro-batch with
``foreachBatch``: every batch runs the *same* domain job as the batch build
against static person / death / visit snapshots (stream-static joins).

A batch's rows lie in ``<out>/s=<stream>/batch=<id>``.  With them it leaves, under ``<state>``,
its violating persons, its code counts, the ids it issued per date (``counters``) and their sum over
all batches so far (``issued``, a row per date).  Its commit marker (``commits.py``) names
that sum, so the next batch reads one marker and one small table, however many batches there
were; streams of one state (T-S4) go on from each other's.  A batch without a marker is run again with
the same offsets and rewrites the same ids; one with a marker is skipped.

With ``dedupe`` each batch leaves out what earlier ones have written (``seen.py``, T-S6);
``finalize`` does the same over the whole output of a stream without it (T13).
The code counts are summed for the unmapped report (K5) and the used concepts.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import vocab
from ..operators.dedupe import dedupe_natural_key
from ..plans import domains as D
from ..session import discard
from ..sources.batches import SOURCE_COLUMNS, compile_batch
from ..spec import Batch, DomainSpec
from . import seen
from .commits import CommitLog

Builder = Callable[[DomainSpec, D.Context, DataFrame], tuple[DataFrame, DataFrame]]
BUILDERS: dict[str, Builder] = {
    "condition": D.condition_build, "drug": D.drug_build, "procedure": D.procedure_build,
    "note": D.note_build, "measurement": D.measurement_build,
    "observation": lambda dom, ctx, src: D.observation_build(dom, ctx, exam=src),
}
INPATIENT_BUILDER: Builder = lambda dom, ctx, src: D.observation_build(dom, ctx, inpatient=src)
ISSUED = T.StructType([T.StructField("_d", T.DateType()), T.StructField("_issued", T.LongType())])


@dataclass(frozen=True)
class StreamFeed:
    """Files of a domain that arrive over time: a folder (observation: a folder per group,
    exam before inpatient), their schema, and the options of a batch."""
    folders: Mapping[str, str] | str
    schema: T.StructType
    options: Batch | None = None
    max_files_per_trigger: int = 1
    fmt: str = "parquet"
    read_options: Mapping[str, str] = field(default_factory=dict)


def issued_before(spark: SparkSession, log: CommitLog, stream_no: int, batch_id: int) -> DataFrame:
    """Offsets ``(_d, _issued)``: ids issued by earlier streams and earlier batches."""
    state = log.before(stream_no, batch_id)
    return spark.read.schema(ISSUED).parquet(state["issued"]) if state else spark.createDataFrame([], ISSUED)


def stream_domain(spark: SparkSession, name: str, dom: DomainSpec, ctx: D.Context, *, source_dir: str,
                  schema: T.StructType, out_dir: str, state_dir: str, stream_no: int = 0,
                  max_files_per_trigger: int = 1, fmt: str = "parquet", builder: Builder | None = None,
                  options: Batch | None = None, dedupe: bool = False, read_options: Mapping[str, str] | None = None) -> int:
    """T-S1 + T-S2 + T-S3 + K4: run ``name``'s domain job over a file stream until
    the files present at start are processed (``availableNow``); returns the
    number of rows written.  ``options`` (a batch without path or frame) gives the hospital
    tag and the batch options; a micro-batch is compiled like any batch (P1-P6, F2, F3)."""
    build = builder or BUILDERS[name]
    log = CommitLog(spark, out_dir)
    written: dict[int, int] = {}

    def process(batch: DataFrame, batch_id: int) -> None:
        if log.read(stream_no, batch_id) is not None:
            return
        at = f"s={stream_no}/batch={batch_id}"
        own = None
        batch = compile_batch(batch, options or Batch(name), SOURCE_COLUMNS.get(name)).persist()
        try:
            offsets = issued_before(spark, log, stream_no, batch_id)
            sctx = replace(ctx, id_offsets=offsets, issued=None, mapped_input={})
            out, invalid = build(dom, sctx, batch)
            table = D.EVENTS[name].table
            if dedupe:
                out, own = seen.unseen(spark, out, table, f"{state_dir}/keys", stream_no, batch_id)
            n = Observation()
            out.observe(n, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out_dir}/{at}")
            if dedupe:
                seen.remember(spark.read.schema(out.schema).parquet(f"{out_dir}/{at}"), table, f"{state_dir}/keys", stream_no, batch_id)
            invalid.write.mode("overwrite").parquet(f"{state_dir}/invalid/{at}")
            if (mapped := sctx.mapped_input.get(name)) is not None:  # K5: codes of this batch
                vocab.code_counts(mapped, dom.mapping).write.mode("overwrite").parquet(f"{state_dir}/codes/{at}")
            issued = sctx.issued if sctx.issued is not None else spark.createDataFrame([], "_d date, n long")
            issued.write.mode("overwrite").parquet(f"{state_dir}/counters/{at}")
            so_far = f"{state_dir}/issued/{uuid.uuid4().hex}"
            delta = spark.read.schema("_d date, n long").parquet(f"{state_dir}/counters/{at}").withColumnRenamed("n", "_issued")
            offsets.unionByName(delta).groupBy("_d").agg(F.sum("_issued").cast("bigint").alias("_issued")).coalesce(1).write.parquet(so_far)
            written[batch_id] = int(n.get.get("n", 0))
            log.write(stream_no, batch_id, {"rows": written[batch_id], "issued": so_far})
            if batch_id > 1 and (old := log.read(stream_no, batch_id - 2)) is not None:
                log.delete(old["issued"])  # nothing goes on from it any more
        finally:
            batch.unpersist()
            if own is not None:
                discard(own)

    stream = (spark.readStream.schema(schema).options(**dict(read_options or {})).option("maxFilesPerTrigger", max_files_per_trigger)
              .format(fmt).load(source_dir))
    q = (stream.writeStream.foreachBatch(process)
         .option("checkpointLocation", f"{state_dir}/checkpoint/s={stream_no}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(written.values())


def stream_feed(spark: SparkSession, name: str, dom: DomainSpec, ctx: D.Context, feed: StreamFeed, *, out_dir: str, state_dir: str,
                dedupe: bool = True) -> int:
    """A domain of a pipeline run as a stream; observation as two that share a counter (T-S4)."""
    parts = [(feed.folders, None)] if isinstance(feed.folders, str) else [(feed.folders[g], g) for g in ("exam", "inpatient") if g in feed.folders]
    rows = 0
    for number, (folder, group) in enumerate(parts):
        rows += stream_domain(spark, name, dom, ctx, source_dir=folder, schema=feed.schema, out_dir=out_dir, state_dir=state_dir, stream_no=number,
                              max_files_per_trigger=feed.max_files_per_trigger, fmt=feed.fmt, options=feed.options, dedupe=dedupe,
                              builder=INPATIENT_BUILDER if group == "inpatient" else None, read_options=feed.read_options)
    return rows


def stream_observation(spark: SparkSession, dom: DomainSpec, ctx: D.Context, *, exam_dir: str, inpatient_dir: str,
                       schema: T.StructType, out_dir: str, state_dir: str, max_files_per_trigger: int = 1) -> None:
    """T-S4: exam then inpatient, two streams sharing one counter."""
    stream_domain(spark, "observation", dom, ctx, source_dir=exam_dir, schema=schema, out_dir=out_dir,
                  state_dir=state_dir, stream_no=0, max_files_per_trigger=max_files_per_trigger)
    stream_domain(spark, "observation", dom, ctx, source_dir=inpatient_dir, schema=schema, out_dir=out_dir,
                  state_dir=state_dir, stream_no=1, max_files_per_trigger=max_files_per_trigger,
                  builder=INPATIENT_BUILDER)


def streamed_codes(spark: SparkSession, state_dir: str) -> DataFrame:
    """The batches' code counts summed (a row per code)."""
    return spark.read.parquet(f"{state_dir}/codes").groupBy("source_code").agg(F.sum("n_rows").alias("n_rows"))


def stream_unmapped(spark: SparkSession, state_dir: str, dom: DomainSpec, ctx: D.Context) -> DataFrame:
    """K5 of a streamed domain: reported from the summed code counts."""
    rule = dom.mapping
    table = vocab.mapping_table(ctx.concept, ctx.relationship, rule.vocabulary_id, require_standard=rule.require_standard)
    return vocab.unmapped_report(streamed_codes(spark, state_dir), table, rule, dom.supplement)


def issued_per_date(spark: SparkSession, state_dir: str) -> DataFrame:
    """A7 / T-S3: (event_date, issued) over all finished batches."""
    return spark.read.parquet(f"{state_dir}/counters").groupBy(F.col("_d").alias("event_date")).agg(F.sum("n").cast("bigint").alias("issued"))


def read_output(spark: SparkSession, out_dir: str) -> DataFrame:
    """All batches committed so far (``s`` and ``batch`` partition columns dropped)."""
    log = CommitLog(spark, out_dir)
    paths = [f"{out_dir}/s={s}/batch={b}" for s in log.streams() for b in log.batches(s)]
    return spark.read.option("basePath", out_dir).parquet(*paths).drop("s", "batch")


def finalize(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """T-S6: natural-key dedupe across batches (streamed ids are unique, the
    lowest sequence wins)."""
    return dedupe_natural_key(read_output(spark, out_dir), table)
