"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with a ``noop`` write (no driver collect).  The
shared person / death / visit build is timed first as ``context``; later queries
reuse its materialised tables, but ``person_build`` and ``visit_build`` build theirs again.  Prints one JSON line on stdout.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["person_build", "visit_build", "condition_build", "drug_build", "procedure_build",
            "observation_build", "note_build", "measurement_build", "visit_match_window7_diff",
            "unmapped_report", "natural_key_dedupe", "qc_report", "compare_mapping_counts", "stream_ids",
            "pipeline_qc"]


def own_builds(spark, sf_dir: str) -> dict:
    """Builds that the shared context has made already, made again to be timed."""
    from clinloom.plans import domains as D
    from clinloom.plans.catalog import context
    from clinloom.sources import derived as dv
    spec, ctx, _ = context(spark, sf_dir)
    return {
        "person_build": lambda: D.person_build(spark, spec.domains["person"], dv.override_sheet_raw(spark, sf_dir),
                                               dv.pseudonym_raw(spark, sf_dir))["person"],
        "visit_build": lambda: D.visit_build(spark, spec.domains["visit"], ctx.person, ctx.death, ctx.excluded,
                                             spec)["visit_occurrence"],
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from clinloom.plans.catalog import QUERIES, context
    from clinloom.session import checkpoint_dir, get_session
    spark = get_session(f"local[{cpus}]", app="clinloom-bench",
                        conf={"spark.sql.shuffle.partitions": str(2 * cpus), "spark.driver.memory": "8g"})
    checkpoint_dir(spark)  # configured shared folder; a scratch one only when none is set
    times: dict[str, float] = {}
    t = time.perf_counter()
    context(spark, sf_dir)
    times["context"] = round(time.perf_counter() - t, 3)
    builds = own_builds(spark, sf_dir)
    for name in HEADLINE:
        t = time.perf_counter()
        builds.get(name, lambda: QUERIES[name](spark, sf_dir))().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
