"""Linking events to visits (J7, J8, J9, W8, W11) and the preceding visit.

Interval join design.  The equi-key of the match is the person and the residual is
a date range, so a person with many visits and events would make one huge join
key.  Time is cut into bins of ``bin_days``; an event lies in one bin, and a visit is laid
into the bins of its window ``[start - window_pre_days, end]``, so the join key is
``(person, bin)`` and no candidate is produced twice.

*Long visits.*  Bins form levels by powers of two: a block of level l has 2**(6 l) bins.  A
window goes to the lowest level at which it touches at most 64 blocks (the calendar ends
within 104 blocks of level 2).  Blocks are then opened level by level, from the top down,
only where the person has events: a block meets the distinct (person, block) cells of the events one level
below, at most 64, so an open-ended visit never spells out its bins and no join is on the person alone.

*Hot cells.*  With ``hot_rows`` the events per (person, bin) are counted first; cells above
that are spread over as many tasks as they hold multiples of it (salt), and only their visits are
repeated.  The list of such cells has at most (events / hot_rows) rows.

The top-1 choice is a ``row_number() = 1`` window partitioned by
``(person, bin, salt, event)``, which the join's hash partitioning
already satisfies (no extra shuffle; Spark plans a WindowGroupLimit).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import EMERGENCY_VISIT

VISIT_COLS = ["visit_occurrence_id", "visit_concept_id", "visit_start_date", "visit_end_date", "provider_id"]


def _epoch_day(c) -> F.Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def dedupe_visit_lookup(visits: DataFrame, *, person_col: str = "person_id", with_provider: bool = True) -> DataFrame:
    """One visit per (person, start, end[, provider]); the lowest id wins.

    An aggregate, so duplicates collapse map-side before the shuffle.
    """
    keys = [person_col, "visit_start_date", "visit_end_date"] + (["provider_id"] if with_provider else [])
    aggs = [F.min("visit_occurrence_id").alias("visit_occurrence_id"),
            F.min_by("visit_concept_id", "visit_occurrence_id").alias("visit_concept_id")]
    if not with_provider and "provider_id" in visits.columns:
        aggs.append(F.min_by("provider_id", "visit_occurrence_id").alias("provider_id"))
    return visits.groupBy(*keys).agg(*aggs)


LEVEL_SHIFT = 6  # a block has 2**6 blocks of the level below
_PER = 1 << LEVEL_SHIFT


def _binned_visits(visits: DataFrame, cells: DataFrame, person_col: str, window_pre_days: int, bin_days: int) -> DataFrame:
    """One row per visit and bin: all bins of a short window, of a long one those that
    ``cells`` (_v_person, _v_bin) name."""
    lo = F.floor((_epoch_day(F.col("visit_start_date")) - window_pre_days) / bin_days).cast("bigint")
    hi = F.floor(_epoch_day(F.col("visit_end_date")) / bin_days).cast("bigint")
    v = visits.where(lo <= hi).select(
        F.col(person_col).alias("_v_person"), F.col("visit_occurrence_id").alias("_v_id"), F.col("visit_concept_id").alias("_v_concept"),
        F.col("visit_start_date").alias("_v_start"), F.col("visit_end_date").alias("_v_end"), F.col("provider_id").alias("_v_provider"),
        lo.alias("_lo"), hi.alias("_hi"))
    kept = [c for c in v.columns if c not in ("_lo", "_hi")]
    at = lambda c, level: F.shiftright(c, level * LEVEL_SHIFT)
    spans = [at("_hi", n) - at("_lo", n) < _PER for n in (0, 1)]
    v = v.withColumn("_level", F.when(spans[0], 0).when(spans[1], 1).otherwise(2))
    laid = lambda n: v.where(F.col("_level") == n).withColumn("_block", F.explode(F.sequence(at("_lo", n), at("_hi", n))))
    # from the top down: a block opens into those of the level below that have events
    cells = cells.where(F.col("_v_person").isNotNull()).select("_v_person", F.col("_v_bin").cast("bigint").alias("_below")).distinct()
    above = cells.select("_v_person", at("_below", 1).alias("_below")).distinct()

    def opened(blocks: DataFrame, below: DataFrame, level: int) -> DataFrame:
        # the cells are as many as there are events: not for the driver
        met = blocks.join(below.withColumn("_block", at("_below", 1)).hint("merge"), ["_v_person", "_block"])
        return met.where(F.col("_below").between(at("_lo", level), at("_hi", level))).withColumn("_block", F.col("_below")).drop("_below")

    ones = laid(1).unionByName(opened(laid(2), above, 1))
    bins = laid(0).unionByName(opened(ones, cells, 0))
    return bins.select(*kept, F.col("_block").alias("_v_bin"))


def event_cells(events: DataFrame, person_col: str, date_col: str, bin_days: int) -> DataFrame:
    """(_v_person, _v_bin, n): the events of each person and bin, written (a narrow table)."""
    from ..session import materialize
    day_bin = F.floor(_epoch_day(F.col(date_col).cast("date")) / bin_days)
    rows = events.select(F.col(person_col).alias("_v_person"), day_bin.alias("_v_bin")).where("_v_person is not null and _v_bin is not null")
    return materialize(rows.groupBy("_v_person", "_v_bin").agg(F.count(F.lit(1)).alias("n")))


def hot_cells(cells: DataFrame, hot_rows: int) -> DataFrame:
    """(_h_person, _h_bin, _parts): cells of more than ``hot_rows`` events and over how many
    tasks to spread them.  Written, so that Spark knows its size before it plans the joins."""
    from ..session import materialize
    return materialize(cells.where(F.col("n") > hot_rows).select(
        F.col("_v_person").alias("_h_person"), F.col("_v_bin").alias("_h_bin"), F.ceil(F.col("n") / hot_rows).cast("int").alias("_parts")))


def _event_key(events: DataFrame) -> F.Column:
    """A key of each event that a recomputed task gives again: its place in the input; for a
    frame without one a number that is unique in a run."""
    from .ids import input_order
    place = input_order(events)
    return F.struct(*place) if "_rid" in place else F.monotonically_increasing_id()


def match_visits(
    events: DataFrame,
    visits: DataFrame,
    *,
    date_col: str,
    person_col: str = "person_id",
    provider_col: str | None = "provider_id",
    window_pre_days: int = 0,
    order_by_diff: bool = False,
    null_9203: str = "none",
    event_key: str | None = None,
    bin_days: int = 7,
    dedupe_lookup: bool = True,
    salt: int = 1,
    hot_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Attach ``visit_occurrence_id`` and ``visit_concept_id`` of the best visit.

    Candidates: same person and ``start - window_pre_days <= date <= end``.  Ranking:
    provider match first (when ``provider_col`` is given; null never equals null),
    then lowest visit concept (nulls last), then optionally fewest days to the
    visit end, then lowest visit id.  ``null_9203``: ``"none"``, ``"pass2"`` (null
    the visit when the winner is an emergency visit without provider match) or
    ``"all"`` (null every emergency winner).  Unmatched events keep null visits.

    ``hot_rows`` spreads the (person, bin) keys of more events than that, ``salt`` > 1 every
    key over at least ``salt`` tasks: events get a salt from a hash of their key and
    visits are repeated once per salt value.  ``counted`` is a cheaper frame that has at
    least the events' persons and dates (the feed they come from); cells are counted in it.
    """
    if null_9203 not in ("none", "pass2", "all"):
        raise ValueError("null_9203 must be none, pass2 or all")
    ev = events.drop("visit_occurrence_id", "visit_concept_id")
    use_provider = provider_col is not None
    if use_provider and provider_col not in ev.columns:
        ev = ev.withColumn(provider_col, F.lit(None).cast("bigint"))
    eid = event_key or "_eid"
    if event_key is None:
        ev = ev.withColumn("_eid", _event_key(ev))
    # An event without a person or a date matches nothing; bins of its own, far before any
    # visit's, keep such events from meeting in one task.
    day_bin = F.floor(_epoch_day(F.col(date_col).cast("date")) / bin_days)
    nowhere = -F.lit(1 << 40) - F.pmod(F.xxhash64(F.col(eid)), F.lit(1 << 20))
    ev = ev.withColumn("_e_bin", F.when(F.col(person_col).isNotNull(), F.coalesce(day_bin, nowhere)).otherwise(nowhere))

    lookup = dedupe_visit_lookup(visits, person_col=person_col) if dedupe_lookup else visits
    cells = event_cells(events if counted is None else counted, person_col, date_col, bin_days)
    vb = _binned_visits(lookup, cells, person_col, window_pre_days, bin_days)
    parts, v_parts = F.lit(salt), F.lit(salt)
    if hot_rows is not None:
        hot = hot_cells(cells, hot_rows)
        ev = ev.join(hot, (ev[person_col] == hot["_h_person"]) & (ev["_e_bin"] == hot["_h_bin"]), "left").drop("_h_person", "_h_bin")
        vb = vb.join(hot.withColumnRenamed("_parts", "_v_parts"), (vb["_v_person"] == hot["_h_person"]) & (vb["_v_bin"] == hot["_h_bin"]), "left").drop(
            "_h_person", "_h_bin")
        parts, v_parts = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(salt)) for c in ("_parts", "_v_parts"))
    ev = ev.withColumn("_salt", F.pmod(F.xxhash64(F.col(eid)), parts).cast("int")).drop("_parts")
    vb = vb.withColumn("_v_salt", F.explode(F.sequence(F.lit(0), v_parts - 1))).drop("_v_parts")
    d = F.col(date_col).cast("date")
    cond = ((ev[person_col] == vb["_v_person"]) & (ev["_e_bin"] == vb["_v_bin"]) & (ev["_salt"] == vb["_v_salt"])
            & (F.date_sub(vb["_v_start"], window_pre_days) <= d) & (d <= vb["_v_end"]))
    cand = ev.join(vb.hint("merge"), cond, "left")  # the window below needs the shuffle anyway, the driver no visits

    pm = (F.coalesce(F.col(provider_col).cast("bigint") == F.col("_v_provider").cast("bigint"), F.lit(False))
          if use_provider else F.lit(False))
    cand = cand.withColumn("_pm", pm)
    order = [F.col("_pm").desc(), F.col("_v_concept").asc_nulls_last()]
    if order_by_diff:
        order.append(F.datediff(F.col("_v_end"), d).asc_nulls_last())
    order.append(F.col("_v_id").asc_nulls_last())
    w = Window.partitionBy(F.col(person_col), F.col("_e_bin"), F.col("_salt"), F.col(eid)).orderBy(*order)
    best = cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)

    vid = F.col("_v_id")
    if null_9203 == "pass2":
        vid = F.when(~F.col("_pm") & (F.col("_v_concept") == EMERGENCY_VISIT), F.lit(None)).otherwise(vid)
    elif null_9203 == "all":
        vid = F.when(F.col("_v_concept") == EMERGENCY_VISIT, F.lit(None)).otherwise(vid)
    out = best.withColumn("visit_occurrence_id", vid.cast("bigint")).withColumn(
        "visit_concept_id", F.col("_v_concept").cast("bigint"))
    drop = ["_v_person", "_v_bin", "_v_id", "_v_concept", "_v_start", "_v_end", "_v_provider",
            "_pm", "_rn", "_e_bin", "_salt", "_v_salt"] + (["_eid"] if event_key is None else [])
    return out.drop(*drop)


def match_visit_two_pass(events: DataFrame, visits: DataFrame, *, date_col: str, person_col: str = "person_id",
                         provider_col: str = "provider_id", window_pre_days: int = 0,
                         order_by_diff: bool = False, null_9203_pass2: bool = False, **kw) -> DataFrame:
    """Provider match first, date-only second, fused into one ranked pass."""
    return match_visits(events, visits, date_col=date_col, person_col=person_col, provider_col=provider_col,
                        window_pre_days=window_pre_days, order_by_diff=order_by_diff,
                        null_9203="pass2" if null_9203_pass2 else "none", **kw)


def match_visit_single(events: DataFrame, visits: DataFrame, *, date_col: str, person_col: str = "person_id",
                       null_9203: bool = True, **kw) -> DataFrame:
    """No provider, window 0, lowest visit concept; emergency winner -> null visit."""
    return match_visits(events, visits, date_col=date_col, person_col=person_col, provider_col=None,
                        window_pre_days=0, order_by_diff=False, null_9203="all" if null_9203 else "none", **kw)


def add_preceding_visit(vo: DataFrame, *, person_col: str = "person_id", bucket_days: int = 30) -> DataFrame:
    """Previous visit of the person if it ended on or before this start, else 0.  The
    order is start, end and the number of the visit in its date (``_seq``; the id where the
    frame has none: its first digits are the hospital's).  Looks one row back only.

    Two levels so that a person with very many visits is not one task: the lag runs
    inside (person, ``bucket_days`` bucket of the start date); the first row of a
    bucket takes the last visit of the person's previous non-empty bucket, found by
    a lag over one summary row per bucket.  Null starts get 0 and are never the
    previous visit of a dated row (they sort last).
    """
    start, end, vid = F.col("visit_start_date"), F.col("visit_end_date"), F.col("visit_occurrence_id")
    seq = F.col("_seq") if "_seq" in vo.columns else vid
    b = F.floor(_epoch_day(start) / bucket_days)
    v = vo.withColumn("_b", b)
    order = [start.asc_nulls_last(), end.asc_nulls_last(), seq.asc_nulls_last()]
    w = Window.partitionBy(person_col, "_b").orderBy(*order)
    v = v.withColumn("_prev_id", F.lag(vid).over(w)).withColumn("_prev_end", F.lag(end).over(w)).withColumn(
        "_first", F.row_number().over(w) == 1)

    last = (vo.where(start.isNotNull()).withColumn("_b", b)
            .groupBy(person_col, "_b")
            .agg(F.max(F.struct(start.alias("s"), F.coalesce(end, F.lit("9999-12-31").cast("date")).alias("e"),
                                F.when(end.isNull(), 1).otherwise(0).alias("n"), seq.alias("q"), vid.alias("i"),
                                end.alias("end"))).alias("_last")))
    wb = Window.partitionBy(person_col).orderBy("_b")
    prev_bucket = last.select(person_col, "_b", F.lag("_last").over(wb).alias("_pl"))
    v = v.join(prev_bucket, [person_col, "_b"], "left")
    pid = F.when(F.col("_first"), F.col("_pl.i")).otherwise(F.col("_prev_id"))
    pend = F.when(F.col("_first"), F.col("_pl.end")).otherwise(F.col("_prev_end"))
    ok = start.isNotNull() & F.coalesce(F.datediff(start, pend) >= 0, F.lit(False))
    return (v.withColumn("preceding_visit_occurrence_id",
                         F.when(ok, pid).otherwise(F.lit(0)).cast("bigint"))
            .drop("_b", "_prev_id", "_prev_end", "_first", "_pl"))
