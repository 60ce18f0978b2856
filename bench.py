"""Benchmark: the report's headline queries on the driver's test tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Each query is built fresh (new catalog, new plan) and
fully executed (collect of the small result, or the writes of the production
run) ``BENCH_REPEAT`` times (default 3); the median is reported, because a
shared host adds a lot of run-to-run noise at these sizes.  One untimed
warm-up query on the same data runs first (JVM start, code generation).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reachlens.operators import roster  # noqa: E402
from reachlens.plans import ReachReport  # noqa: E402
from reachlens.session import local_session, shared_dir  # noqa: E402
from reachlens.sources.bindings import (FIXTURE_AS_OF, FIXTURE_RANGE,  # noqa: E402
                                        FIXTURE_SCOPE, GROWING, bound_catalog)


def _commit() -> str | None:
    """Short hash of the measured code, when the repo is a git checkout."""
    import subprocess
    try:
        out = subprocess.run(["git", "-C", os.path.dirname(os.path.abspath(__file__)),
                              "rev-parse", "--short", "HEAD"], capture_output=True,
                             text=True, timeout=10)
        return out.stdout.strip() or None
    except (OSError, subprocess.SubprocessError):
        return None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app_name="reachlens-bench")
    out_root = shared_dir(spark, fallback=lambda: tempfile.mkdtemp(prefix="reachlens-bench-"))

    def day() -> ReachReport:
        return ReachReport(bound_catalog(spark, sf_dir), FIXTURE_AS_OF, scope=FIXTURE_SCOPE)

    def span() -> ReachReport:
        return ReachReport(bound_catalog(spark, sf_dir), *FIXTURE_RANGE, scope=FIXTURE_SCOPE)

    run_count = {"n": 0}

    def run_dir() -> str:
        run_count["n"] += 1
        return f"{out_root}/bench-run-{run_count["n"]}"

    def merged(query):
        """``query`` with broadcast joins off."""
        keys = ("spark.sql.autoBroadcastJoinThreshold",
                "spark.sql.adaptive.autoBroadcastJoinThreshold")
        old = {k: spark.conf.get(k, None) for k in keys}
        for k in keys:
            spark.conf.set(k, "-1")
        try:
            return query()
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    queries = {
        # the command line's default: wide table written to the shared folder,
        # summary, total and diagnostics from it
        "daily_report_run": lambda: day().run(run_dir()),
        "report_summary_total": lambda: day().summary_with_total().collect(),
        "report_combined": lambda: day().combined().collect(),
        "backfill_31d_run": lambda: span().run(run_dir()),
        # an activity side as large as the data, joined by sort-merge
        "growing_day_reach": lambda: merged(lambda: day().wide([GROWING]).collect()),
        "growing_range_reach": lambda: merged(lambda: span().wide([GROWING]).collect()),
        "metric_case_study_count": lambda: day().metric_frame("case_study_count").collect(),
        "metric_total_attendance": lambda: day().metric_frame("total_attendance").collect(),
        "eligible_students": lambda: roster.eligible_students(
            bound_catalog(spark, sf_dir), FIXTURE_SCOPE).count(),
    }

    t0 = time.perf_counter()
    day().summary_with_total().collect()
    warmup = time.perf_counter() - t0

    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    timings, spread = {}, {}
    for name, fn in queries.items():
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
        spread[name] = [round(min(runs), 3), round(max(runs), 3)]

    print(json.dumps({
        "metric": "reachlens_headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "warmup_sec": round(warmup, 3),
        "repeat": repeat,
        "min_max": spread,
        "commit": _commit(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
