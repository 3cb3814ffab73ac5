"""Commit markers, counter sums and the incremental dedupe of streams."""
import os

from pyspark.sql import functions as F

from clinloom.operators.dedupe import dedupe_natural_key
from clinloom.plans.catalog import QUERIES, context, stream_condition
from clinloom.sources.batches import load_batches
from clinloom.streaming import seen
from clinloom.streaming.commits import CommitLog
from clinloom.streaming.incremental import read_output, stream_domain

SF = "/root/testdata/sf0.001"


def test_commit_log(spark, tmpdir_path):
    log = CommitLog(spark, tmpdir_path)
    assert log.before(0, 0) is None and log.last() is None and log.read(0, 0) is None
    for b in range(50):
        log.write(0, b, {"issued": f"p{b}"})
    log.write(1, 0, {"issued": "q0"})
    assert log.before(0, 7) == {"issued": "p6"} and log.before(1, 0) == {"issued": "p49"} and log.before(1, 3) == {"issued": "q0"}
    assert log.before(0, 0) is None and log.last() == {"issued": "q0"}
    assert log.batches(0) == list(range(50)) and log.streams() == [0, 1]
    log.write(0, 3, {"issued": "again"})  # a marker stays as it is
    assert log.read(0, 3) == {"issued": "p3"}


def test_state_stays_small_and_replays_are_skipped(spark, tmpdir_path):
    spec, ctx, _ = context(spark, SF)
    dom = spec.domains["condition"]
    feed = load_batches(spark, dom)
    for i in range(5):
        feed.where(F.col("_rid") % 5 == i).coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/source")
    run = lambda state: stream_domain(spark, "condition", dom, ctx, source_dir=f"{tmpdir_path}/source", schema=feed.schema,
                                      out_dir=f"{tmpdir_path}/out", state_dir=f"{tmpdir_path}/{state}")
    first = run("state")
    assert first > 0 and len(os.listdir(f"{tmpdir_path}/state/issued")) == 2  # the sums of the last two batches
    ids = sorted(r[0] for r in read_output(spark, f"{tmpdir_path}/out").select("condition_occurrence_id").collect())
    assert len(ids) == len(set(ids))
    # the checkpoint is lost after the commits: all batches come again and are skipped
    assert run("other") == 0
    assert sorted(r[0] for r in read_output(spark, f"{tmpdir_path}/out").select("condition_occurrence_id").collect()) == ids


def test_half_written_batches_are_not_read(spark, tmpdir_path):
    base, out = stream_condition(spark, SF, files=2)
    n = out.count()
    spark.range(3).withColumn("condition_occurrence_id", F.col("id")).write.parquet(f"{base}/out/s=0/batch=99")
    assert read_output(spark, f"{base}/out").count() == n


def test_incremental_dedupe_equals_the_whole(spark, tmpdir_path):
    table = QUERIES["condition_build"](spark, SF).limit(40)
    rows = [table.where(F.col("condition_occurrence_id") % 3 == i) for i in range(3)]
    rows = [rows[0], rows[1].unionByName(rows[0]), rows[2].unionByName(rows[1]).unionByName(rows[2]), rows[0]]
    written = []
    for b, r in enumerate(rows):
        fresh, _ = seen.unseen(spark, r, "condition_occurrence", f"{tmpdir_path}/keys", 0, b)
        for _ in range(2):  # a batch that runs again finds the same rows unseen
            fresh, own = seen.unseen(spark, r, "condition_occurrence", f"{tmpdir_path}/keys", 0, b)
            kept = fresh.collect()
            if kept:
                seen.remember(spark.createDataFrame(kept, table.schema), "condition_occurrence", f"{tmpdir_path}/keys", 0, b)
        written += kept
    whole = dedupe_natural_key(table, "condition_occurrence").collect()
    assert sorted(map(tuple, written), key=str) == sorted(map(tuple, whole), key=str)
    months = {tuple(x) for x in table.select(F.year("condition_start_date") * 12 + F.month("condition_start_date")).distinct().collect()}
    assert {f"m={m[0]}" for m in months} == {d for d in os.listdir(f"{tmpdir_path}/keys") if d.startswith("m=")}


def test_nulls_are_told_apart(spark):
    from clinloom.schema import CDM_TABLES
    types = dict(CDM_TABLES["condition_occurrence"])
    empty = spark.createDataFrame([()], "struct<>").select(*(F.lit(None).cast(t).alias(c) for c, t in types.items()))
    a = empty.withColumn("stop_reason", F.lit("x"))
    b = empty.withColumn("condition_source_value", F.lit("x"))
    keys = a.unionByName(b).withColumns(seen.key_columns("condition_occurrence")).select("_k1", "_k2").distinct()
    assert keys.count() == 2
