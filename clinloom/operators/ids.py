"""Date-scoped surrogate keys.

An occurrence id is ``{hosp}{YY}{MM}{DD}{domain_code}{seq}``: rows are numbered
1..N within their calendar date, ordered by event time (nulls last) and then by
explicit tie columns (the source has no row order in Spark, so the caller names
what "input order" means; by default the batch ordinal ``_batch`` and the row id ``_rid``
within the batch, as far as the frame has them).

Two physical strategies give identical numbers:

* ``"bucketed"`` (default): rows are numbered inside (date, time bucket, tie
  buckets), where the time bucket is the minute of the event time counted from the
  date's midnight (``bucket_minutes`` wide, its very start apart) and, among equal times
  only, the tie buckets are ``_batch`` and
  ``_rid >> 33`` (the input split of a ``monotonically_increasing_id`` row id).  The keys
  follow the sort order, so the sequence is the local number plus the count of the same date in earlier
  buckets, taken from a per-bucket count table.  A hot date is spread over many
  tasks; every key is a pure function of the row, so a recomputed task (lost
  executor) gets the same numbers.
* ``"window"``: ``row_number()`` over ``partitionBy(date)``.  One shuffle, but a
  date is one task; fine when no date is hot.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import build_id, pad_widening, yymmdd

_POS_SHIFT = 33  # monotonically_increasing_id() = input partition << 33 | row position
_NULL_LAST = 2**62


def _hosp_text(df: DataFrame, hosp_col: str) -> Column:
    if hosp_col not in df.columns:
        raise ValueError(f"column '{hosp_col}' is needed to issue ids but is absent (T30)")
    h = F.col(hosp_col).cast("bigint")
    return F.when(h.isNotNull(), h.cast("string")).otherwise(
        F.raise_error(F.lit(f"null '{hosp_col}' while issuing ids: set hosp on the batch")))


def input_order(df: DataFrame) -> list[str]:
    """Columns whose order is the input order: the batch, then the row in its batch."""
    return [c for c in ("_batch", "_rid") if c in df.columns]


def number_within_date(
    df: DataFrame,
    *,
    date_col: str,
    order_col: str | None,
    tie_cols: Sequence[str] | None = None,
    seq_col: str = "_seq",
    method: str = "bucketed",
    bucket_minutes: int = 1,
    materialize: bool = True,
) -> DataFrame:
    """Add ``seq_col`` = 1..N within each value of ``date_col``.

    Order inside a date: ``order_col`` ascending, nulls last, then ``tie_cols``.
    Rows with a null date are dropped first (F9).  With ``materialize`` the
    locally numbered rows are written once into the shared checkpoint folder, so the count branch and the
    main branch read the same files instead of running the upstream plan twice.
    """
    tie_cols = input_order(df) if tie_cols is None else list(tie_cols)
    d = F.col(date_col).cast("date")
    df = df.where(d.isNotNull()).withColumn("_d", d)
    order: list[Column] = ([F.col(order_col).asc_nulls_last()] if order_col else []) + [
        F.col(t).asc_nulls_last() for t in tie_cols]

    if method == "window":
        w = Window.partitionBy("_d").orderBy(*order)
        return df.withColumn(seq_col, F.row_number().over(w)).drop("_d")
    if method not in ("bucketed", "range"):
        raise ValueError(f"unknown numbering method {method!r}")

    # Buckets in the sort order: the minute, in it first the rows at its very start (all
    # of date-only times), and only among equal times the batch and the input split.
    equal = F.lit(True)
    tb = F.lit(0).cast("bigint")
    if order_col:
        t = F.col(order_col)
        mins = F.datediff(F.to_date(t), F.col("_d")) * 1440 + F.hour(t) * 60 + F.minute(t)
        at_start = (F.pmod(mins, F.lit(bucket_minutes)) == 0) & (F.date_trunc("minute", t) == t)
        tb = F.coalesce(2 * F.floor(mins / bucket_minutes) + F.when(at_start, 0).otherwise(1), F.lit(_NULL_LAST))
        equal = t.isNull() | at_start
    named = [c for c, n in zip(tie_cols, input_order(df), strict=False) if c == n]
    last = F.lit(_NULL_LAST)
    batch = F.coalesce(F.col("_batch").cast("bigint"), last) if "_batch" in named else F.lit(0)
    split = F.coalesce(F.shiftright(F.col("_rid").cast("bigint"), _POS_SHIFT), last) if "_rid" in named else F.lit(0)
    df = df.withColumns({"_tb": tb.cast("bigint"), "_pb": F.when(equal, batch).otherwise(0).cast("bigint"),
                         "_rb": F.when(equal, split).otherwise(0).cast("bigint")})
    keys = ["_d", "_tb", "_pb", "_rb"]
    local = df.withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    if materialize:
        from ..session import materialize as _materialize
        local = _materialize(local)
    # One row per (date, time bucket, tie bucket): map-side partial aggregation.
    counts = local.groupBy(*keys).agg(F.max("_local").alias("_n"))
    before = Window.partitionBy("_d").orderBy("_tb", "_pb", "_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    out = local.join(offsets, keys)
    return (out.withColumn(seq_col, (F.col("_local") + F.col("_base")).cast("bigint"))
            .drop("_tb", "_pb", "_rb", "_local", "_base", "_d"))


def occurrence_id(hosp: Column, date: Column, domain_code: str, seq: Column, seq_width: int) -> Column:
    """C11 for the common layout ``hosp YYMMDD code seq``."""
    return build_id(hosp, yymmdd(date), F.lit(domain_code), pad_widening(seq, seq_width))


def assign_occurrence_id(
    df: DataFrame,
    *,
    id_col: str,
    datetime_col: str | None,
    date_col: str,
    domain_code: str,
    seq_width: int = 5,
    hosp_col: str = "hosp",
    tie_cols: Sequence[str] | None = None,
    keep_seq: bool = False,
    method: str = "bucketed",
) -> DataFrame:
    """Drop null dates, number rows per calendar date, build the id.

    O1: the order is the event time (nulls last) then the tie columns; it exists
    only inside each date's numbering, never as a global sort.
    """
    hosp = _hosp_text(df, hosp_col)
    out = number_within_date(df.withColumn("_hosp_txt", hosp), date_col=date_col,
                             order_col=datetime_col, tie_cols=tie_cols, method=method)
    out = out.withColumn(id_col, occurrence_id(F.col("_hosp_txt"), F.col(date_col).cast("date"),
                                               domain_code, F.col("_seq"), seq_width))
    out = out.drop("_hosp_txt")
    return out if keep_seq else out.drop("_seq")


def payer_plan_period_id(hosp: Column, date: Column, seq: Column, width: int = 5) -> Column:
    """``hosp YYMMDD 07 seq`` with the visit's sequence."""
    return build_id(hosp.cast("bigint").cast("string"), yymmdd(date), F.lit("07"), pad_widening(seq, width))


def visit_cost_id(hosp: Column, date: Column, seq: Column, width: int = 5) -> Column:
    """Cost ids put the code before the hospital: ``YYMMDD 08 hosp seq``."""
    return build_id(yymmdd(date), F.lit("08"), hosp.cast("bigint").cast("string"), pad_widening(seq, width))


def assign_ids_with_offsets(
    df: DataFrame,
    offsets: DataFrame,
    *,
    id_col: str,
    date_col: str,
    domain_code: str,
    seq_width: int = 6,
    hosp_col: str = "hosp",
    arrival_cols: Sequence[str] | None = None,
    method: str = "bucketed",
) -> DataFrame:
    """Streaming ids.  ``offsets`` holds (``_d`` date, ``_issued`` count issued
    before this batch); the sequence continues from there in arrival order.

    A micro-batch may be one very large file of one date, so it is numbered in buckets of
    the input splits like a batch build; ``df`` should be a written table, as it is read
    twice.  The offsets frame has one row per date and is left to AQE's runtime size check.
    """
    hosp = _hosp_text(df, hosp_col)
    numbered = number_within_date(df.withColumn("_hosp_txt", hosp), date_col=date_col,
                                  order_col=None, tie_cols=arrival_cols, method=method, materialize=False)
    numbered = numbered.withColumn("_d", F.col(date_col).cast("date"))
    out = numbered.join(offsets.select("_d", "_issued"), "_d", "left")
    seq = F.col("_seq") + F.coalesce(F.col("_issued"), F.lit(0))
    return (out.withColumn(id_col, occurrence_id(F.col("_hosp_txt"), F.col("_d"), domain_code, seq, seq_width))
            .drop("_hosp_txt", "_seq", "_issued", "_d"))
