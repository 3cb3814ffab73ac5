"""Seeded random fixtures checked against brute-force Python versions of the rules."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clinloom.functions import columns as C
from clinloom.operators import ids, visits

BASE = dt.date(2024, 1, 1)


def _random_visits(rng, n_persons, n):
    rows = []
    for vid in range(1, n + 1):
        s = BASE + dt.timedelta(days=rng.randrange(60))
        e = s + dt.timedelta(days=rng.choice([0, 0, 1, 3, 12, 40, -1]))  # -1: end before start
        rows.append((rng.randrange(n_persons), vid * 10, rng.choice([9201, 9202, 9203, None]), s, e,
                     rng.choice([1, 2, 3, None])))
    return rows


def _brute_match(events, vis, pre, diff, provider, null_9203):
    # One visit per (person, start, end, provider), the lowest id
    best_lookup = {}
    for v in vis:
        k = (v[0], v[3], v[4], v[5])
        if k not in best_lookup or v[1] < best_lookup[k][1]:
            best_lookup[k] = v
    out = {}
    for eid, p, d, prov in events:
        cands = [v for v in best_lookup.values()
                 if v[0] == p and d is not None and v[3] - dt.timedelta(days=pre) <= d <= v[4]]
        if not cands:
            out[eid] = (None, None)
            continue

        def key(v):
            pm = provider and prov is not None and v[5] is not None and prov == v[5]
            return (not pm, v[2] is None, v[2] or 0, (v[4] - d).days if diff else 0, v[1])
        w = min(cands, key=key)
        pm = provider and prov is not None and w[5] is not None and prov == w[5]
        vid = w[1]
        if (null_9203 == "pass2" and not pm and w[2] == 9203) or (null_9203 == "all" and w[2] == 9203):
            vid = None
        out[eid] = (vid, w[2])
    return out


@pytest.mark.parametrize("seed,pre,diff,provider,null_9203,salt,bin_days", [
    (1, 0, False, True, "none", 1, 7), (2, 7, True, True, "pass2", 3, 5), (3, 0, False, False, "all", 1, 2),
    (4, 7, True, True, "pass2", 1, 30)])
def test_visit_match_vs_brute_force(spark, seed, pre, diff, provider, null_9203, salt, bin_days):
    rng = random.Random(seed)
    vis = _random_visits(rng, 6, 80)
    events = [(i, rng.randrange(7), rng.choice([None] + [BASE + dt.timedelta(days=rng.randrange(70))] * 8),
               rng.choice([1, 2, 3, None])) for i in range(300)]
    vdf = spark.createDataFrame(vis, "person_id long, visit_occurrence_id long, visit_concept_id long, "
                                     "visit_start_date date, visit_end_date date, provider_id long")
    edf = spark.createDataFrame(events, "eid long, person_id long, d date, provider_id long")
    m = visits.match_visits(edf, vdf, date_col="d", provider_col="provider_id" if provider else None,
                            window_pre_days=pre, order_by_diff=diff, null_9203=null_9203, salt=salt,
                            bin_days=bin_days, event_key="eid" if seed % 2 else None)
    got = {r.eid: (r.visit_occurrence_id, r.visit_concept_id) for r in m.collect()}
    assert len(got) == len(events) == m.count()
    assert got == _brute_match(events, vis, pre, diff, provider, null_9203)


@pytest.mark.parametrize("method", ["bucketed", "window"])
def test_numbering_vs_brute_force_with_hot_date(spark, method):
    rng = random.Random(7)
    rows = []
    for rid in range(3000):
        # a third of the rows on one hot date, many sharing the same timestamp (ties by _rid)
        d = BASE if rid % 3 == 0 else BASE + dt.timedelta(days=rng.randrange(5))
        t = None if rid % 50 == 0 else dt.datetime.combine(d, dt.time(rng.randrange(3), rng.choice([0, 30])))
        rows.append((rid * 7919 % 100003, rng.choice([1, 2]), d, t))
    df = spark.createDataFrame(rows, "_rid long, hosp int, d date, t timestamp_ntz")
    out = ids.assign_occurrence_id(df, id_col="oid", datetime_col="t", date_col="d", domain_code="05",
                                   seq_width=6, method=method)
    got = {r._rid: r.oid for r in out.collect()}
    by_date = {}
    for rid, h, d, t in rows:
        by_date.setdefault(d, []).append((t is None, t or dt.datetime.min, rid, h))
    expect = {}
    for d, lst in by_date.items():
        for seq, (_, _, rid, h) in enumerate(sorted(lst), start=1):
            expect[rid] = int(f"{h}{d:%y%m%d}05{seq:06d}")
    assert got == expect


def test_preceding_visit_vs_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for vid in range(1, 400):
        s = None if vid % 37 == 0 else BASE + dt.timedelta(days=rng.randrange(200))
        e = None if s is None or vid % 41 == 0 else s + dt.timedelta(days=rng.choice([0, 1, 2, 5]))
        rows.append((rng.randrange(5), vid, s, e))
    df = spark.createDataFrame(rows, "person_id long, visit_occurrence_id long, visit_start_date date, "
                                     "visit_end_date date")
    got = {r.visit_occurrence_id: r.preceding_visit_occurrence_id
           for r in visits.add_preceding_visit(df, bucket_days=17).collect()}
    expect = {}
    for p in {r[0] for r in rows}:
        lst = sorted((r for r in rows if r[0] == p),
                     key=lambda r: (r[2] is None, r[2] or BASE, r[3] is None, r[3] or BASE, r[1]))
        prev = None
        for r in lst:
            ok = prev is not None and r[2] is not None and prev[3] is not None and (r[2] - prev[3]).days >= 0
            expect[r[1]] = prev[1] if ok else 0
            prev = r
    assert got == expect


def test_kcd_normalise_vs_python(spark):
    rng = random.Random(3)
    alphabet = "AbZ09.| -x"
    vals = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 9))) for _ in range(400)]

    def rule(s):
        code = s.split("|")[0].strip(" ").upper()
        return code[:3] + "." + code[3:] if len(code) > 3 and "." not in code else code
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = {r.i: r.c for r in df.select("i", C.kcd_normalise(F.col("v")).alias("c")).collect()}
    assert got == {i: rule(v) for i, v in enumerate(vals)}
