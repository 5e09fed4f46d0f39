"""Benchmark the headline queries.

Runs every report dataset (C-*), plus the streaming variants (T-*), on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``.
Each query is executed in full through the ``noop`` sink (no driver collect),
once to warm up and then ``$BENCH_REPEAT`` times (default 3); the median is
reported.  The Spark jobs and stages of one timed run per query are recorded
too (``plan_shape``; stage counts include stages skipped by shuffle reuse).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE_PREFIXES = ("c", "t")


def run_once(fn, spark, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [p for p in os.environ.get("BENCH_ONLY", "").split(",") if p]

    from worklens.catalog import QUERIES
    from worklens.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="worklens-bench")
    keys = [k for k in QUERIES if k.startswith(HEADLINE_PREFIXES)]
    if only:
        keys = [k for k in keys if any(k.startswith(p) for p in only)]
    times: dict[str, float] = {}
    shape: dict[str, dict[str, int]] = {}
    errors: dict[str, str] = {}
    sc = spark.sparkContext
    for key in keys:
        fn = QUERIES[key]
        try:
            run_once(fn, spark, sf_dir)  # warm-up (one-time dimension checks, codegen)
            runs = []
            for n in range(repeat):
                sc.setJobGroup(f"timed-{key}-{n}", key)
                runs.append(run_once(fn, spark, sf_dir))
            jobs = sc.statusTracker().getJobIdsForGroup(f"timed-{key}-0")
            stages = sum(len(info.stageIds) for j in jobs
                         if (info := sc.statusTracker().getJobInfo(j)) is not None)
            shape[key] = {"jobs": len(jobs), "stages": stages}
            times[key] = round(statistics.median(runs), 3)
        except Exception as exc:  # record and keep timing the others
            errors[key] = repr(exc)[:300]
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "errors": errors,
        "plan_shape": shape,
        "config": {"master": f"local[{cpus}]", "repeat": repeat, "warmup": 1,
                   "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                   "aqe": spark.conf.get("spark.sql.adaptive.enabled")},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
