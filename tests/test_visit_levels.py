"""The interval join over block levels and hot cells against brute force."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clinloom.operators import visits
from test_properties import _brute_match

DAY0 = dt.date(2000, 1, 1)


def _visits(rng, n):
    """Windows of a day to eight thousand years, some before 1970."""
    out = []
    for i in range(n):
        start = DAY0 + dt.timedelta(days=rng.randrange(-20_000, 9_000))
        span = rng.choice([0, 3, 100, 500, 4_000, 40_000, 400_000])
        end = dt.date(9999, 12, 31) if rng.random() < 0.1 else min(start + dt.timedelta(days=span), dt.date(9999, 12, 31))
        out.append((rng.randrange(5), 1000 + i, rng.choice([9201, 9202, 9203, None]), start, end, rng.choice([1, 2, None])))
    return out


@pytest.mark.parametrize("seed,bin_days,hot_rows,salt", [(1, 1, None, 1), (2, 7, 3, 1), (3, 30, 1, 2), (4, 1, 2, 1)])
def test_long_windows_vs_brute_force(spark, seed, bin_days, hot_rows, salt):
    rng = random.Random(seed)
    vis = _visits(rng, 60)
    hot = DAY0 + dt.timedelta(days=5_000)
    events = [(i, rng.choice([0, 0, 1, 2, 3, 4, 9, None]), rng.choice([None, hot, hot] + [DAY0 + dt.timedelta(days=rng.randrange(-21_000, 30_000))] * 5),
               rng.choice([1, 2, 3, None])) for i in range(400)]
    vdf = spark.createDataFrame(vis, "person_id long, visit_occurrence_id long, visit_concept_id long, "
                                     "visit_start_date date, visit_end_date date, provider_id long")
    edf = spark.createDataFrame(events, "eid long, person_id long, d date, provider_id long")
    m = visits.match_visits(edf, vdf, date_col="d", window_pre_days=7, order_by_diff=True, event_key="eid", bin_days=bin_days,
                            hot_rows=hot_rows, salt=salt)
    got = {r.eid: (r.visit_occurrence_id, r.visit_concept_id) for r in m.collect()}
    assert got == _brute_match(events, vis, 7, True, True, "none")


def test_windows_meet_each_cell_once(spark):
    """Windows of all lengths and places: exactly the person's cells inside, once each."""
    spans = [(lo, lo + n) for lo in (-700, -64, -1, 0, 5, 63, 64, 1000) for n in (0, 1, 62, 63, 64, 127, 128, 129, 200, 4096, 10_000, 400_000)]
    day = lambda n: DAY0.replace(year=1970) + dt.timedelta(days=n)
    vis = spark.createDataFrame([(1, i, 9201, day(lo), day(hi), 1) for i, (lo, hi) in enumerate(spans)],
                                "person_id long, visit_occurrence_id long, visit_concept_id long, visit_start_date date, visit_end_date date, provider_id long")
    some = [*range(-800, 1200, 3), *range(2_000, 12_000, 61), 300_000, 399_999]
    cells = spark.createDataFrame([(p, b) for b in some for p in (1, 2, None)], "_v_person long, _v_bin long")
    got = {}
    for r in visits._binned_visits(vis, cells.unionAll(cells), "person_id", 0, 1).collect():
        got.setdefault(r._v_id, []).append(r._v_bin)
    for i, (lo, hi) in enumerate(spans):
        inside = list(range(lo, hi + 1)) if hi - lo < 64 else [b for b in some if lo <= b <= hi]
        assert sorted(got.get(i, [])) == inside


def test_no_join_on_the_person_alone(spark):
    vis = spark.createDataFrame(_visits(random.Random(0), 5), "person_id long, visit_occurrence_id long, visit_concept_id long, "
                                "visit_start_date date, visit_end_date date, provider_id long")
    ev = spark.createDataFrame([(1, 0, DAY0, 1)], "eid long, person_id long, d date, provider_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = visits.match_visits(ev, vis, date_col="d", event_key="eid", hot_rows=10)
        plan = m._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("," in line.split("[")[1].split("]")[0] for line in joins)


def test_hot_cells_are_spread(spark):
    """A person with a third of all events: no (person, bin, salt) key keeps more than a part."""
    events = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).cast("long").alias("person_id"),
                                        F.date_add(F.lit(DAY0), (F.col("id") % 2).cast("int")).alias("d"))
    hot = visits.hot_cells(visits.event_cells(events, "person_id", "d", 1), 500).collect()
    assert {(r._h_person, r._parts) for r in hot} == {(7, 10)} and len(hot) == 2
