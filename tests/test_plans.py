"""Plan shape: filters reach the scan, shared sources are scanned once, no
cartesian or nested-loop joins, one shaping aggregation."""

import json
import os
import re
import subprocess
import sys
import textwrap

import pytest

from reachlens.plans import ReachReport
from reachlens.sources.bindings import FIXTURE_AS_OF, FIXTURE_RANGE, FIXTURE_SCOPE, bound_catalog
from reachlens.sources.catalog import Catalog
from reachlens.specs import table_schemas


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def stored(spark):
    import tempfile

    from reachlens.session import shared_dir
    root = tempfile.mkdtemp(prefix="plans-", dir=shared_dir(spark))
    bound = bound_catalog(spark, "/root/testdata/sf0.001")
    for name in table_schemas():
        bound.table(name).write.parquet(os.path.join(root, name))
    return root


def plan_text(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")  # untruncated scan lines
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def scans_of(text: str, table: str) -> list[str]:
    return [line for line in text.splitlines()
            if "FileScan parquet" in line and f"/{table}]" in line]


def test_window_and_scope_reach_the_scan(spark, stored):
    rep = ReachReport(Catalog.from_parquet(spark, stored), FIXTURE_AS_OF, scope=FIXTURE_SCOPE)
    text = plan_text(rep.combined())
    live = scans_of(text, "questionnaire_live")
    assert live and "GreaterThanOrEqual(start_time,2024-01-14T08:00)" in live[0]
    assert "LessThanOrEqual(start_time,2024-01-15T08:00)" in live[0]
    remedial = scans_of(text, "questionnaire_remedial_path")
    assert remedial and "GreaterThanOrEqual(created_at,2024-01-14T08:00)" in remedial[0]
    attendance = scans_of(text, "faculty_class_hours")
    assert attendance and ("EqualTo(entry_date,2024-01-15)" in attendance[0]
                           or "GreaterThanOrEqual(entry_date,2024-01-15)" in attendance[0])
    roster = scans_of(text, "student_college_details")
    assert roster and "In(college_id" in roster[0]
    # column pruning: the bridge scan reads only the two columns it needs
    bridge = scans_of(text, "questionnaire_live_has_students")
    assert re.search(r"ReadSchema: struct<student_id:bigint,questionnaire_id:bigint>", bridge[0])


def test_shared_source_is_scanned_once(spark, stored):
    rep = ReachReport(Catalog.from_parquet(spark, stored), FIXTURE_AS_OF, scope=FIXTURE_SCOPE)
    text = plan_text(rep.combined())
    assert len(scans_of(text, "questionnaire_subjective_has_students")) == 1
    assert len(scans_of(text, "questionnaire_subjective")) == 1


@pytest.mark.parametrize("which", ["combined", "summary_with_total", "backfill", "case_study"])
def test_no_cartesian_or_nested_loop(spark, stored, which):
    cat = Catalog.from_parquet(spark, stored)
    if which == "backfill":
        df = ReachReport(cat, *FIXTURE_RANGE, scope=FIXTURE_SCOPE).combined()
    elif which == "case_study":
        df = ReachReport(cat, FIXTURE_AS_OF, scope=FIXTURE_SCOPE).metric_frame("case_study_count")
    else:
        df = getattr(ReachReport(cat, FIXTURE_AS_OF, scope=FIXTURE_SCOPE), which)()
    text = df._jdf.queryExecution().optimizedPlan().toString() + plan_text(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Join Cross" not in text
    # every aggregation keeps a hash-based (map-side partial) form
    assert "SortAggregate" not in plan_text(df)


def test_one_shaping_aggregation_and_no_union_for_total_row(spark, stored):
    rep = ReachReport(Catalog.from_parquet(spark, stored), FIXTURE_AS_OF, scope=FIXTURE_SCOPE)
    optimized = rep.summary_with_total()._jdf.queryExecution().optimizedPlan().toString()
    # the total row comes from the rank window, not a second aggregation or a
    # second copy of the report: one exchange by report date serves both windows
    assert "Expand" not in optimized
    physical = plan_text(rep.summary_with_total())
    assert len(re.findall(r"Exchange hashpartitioning\(report_date#\d+, \d+\)", physical)) == 1
    assert len(scans_of(plan_text(rep.summary_with_total()), "questionnaire_live")) == 1


def test_bridge_id_range_pruning_is_exact_and_pushed(spark, stored):
    cat = Catalog.from_parquet(spark, stored)
    plain = ReachReport(cat, *FIXTURE_RANGE, scope=FIXTURE_SCOPE).combined()
    pruned_report = ReachReport(Catalog.from_parquet(spark, stored), *FIXTURE_RANGE,
                                scope=FIXTURE_SCOPE, prune_bridges=True)
    pruned = pruned_report.combined()
    bridge = scans_of(plan_text(pruned), "questionnaire_live_has_students")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, pruned.collect()))
    assert "GreaterThanOrEqual(questionnaire_id," in bridge[0]
    assert "LessThanOrEqual(questionnaire_id," in bridge[0]
    # a window with no activity empties the branch instead of scanning the bridge
    empty = ReachReport(Catalog.from_parquet(spark, stored), "2030-01-01",
                        scope=FIXTURE_SCOPE, prune_bridges=True)
    assert all(r.total_live_assignment == 0 for r in empty.combined().collect())


HOT = textwrap.dedent("""
    import json, re, sys
    sys.path[:0] = [{root!r}, {root!r} + "/tests"]
    from pyspark.sql import SparkSession, functions as F
    from helpers import enrol, make_catalog, ts
    from reachlens.operators import activity
    from reachlens.plans import ReachReport
    from reachlens.specs import metric, report_metrics
    # a plain session: nothing set but that joins are not broadcast
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "32")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    t = ts("2024-01-15 01:00:00")
    students = range(1, 4001)
    cat = make_catalog(spark, {{
        "college": [(1, "A"), (2, "B")],
        "student_college_details": [enrol(s, 1 + s % 2) for s in students],
        "questionnaire_live": [(e, t) for e in range(1, 52)],
        "questionnaire_live_has_students": [(s, 1) for s in students]
        + [(s, 2 + s % 50) for s in students if s % 7 == 0]}})
    rep = ReachReport(cat, "2024-01-15", scope=[1, 2])
    out = {{}}
    for name, specs in (("single", [metric("total_live_assignment")]), ("wide", report_metrics())):
        pairs = activity.activity_pairs(cat, specs, rep.start, rep.end)
        tasks = (pairs.where("event_id = 1").groupBy(F.spark_partition_id().alias("p")).count().collect())
        counts = rep.counts(specs)
        text = counts._jdf.queryExecution().executedPlan().toString()
        eligible = activity.of_students(pairs, rep.members().select("student_id").distinct())
        distinct = eligible.distinct().groupBy(F.spark_partition_id().alias("p")).count().collect()
        out[name] = [len(tasks), max(r["count"] for r in tasks), "SortMergeJoin" in text,
                     max(r["count"] for r in distinct), text.count("LeftSemi")]
    hot = activity.hot_links(cat, activity.grouped_sources([metric("total_live_assignment")]), rep.start, rep.end)
    out["hot"] = [h["event_id"] for h in hot.values()]
    one = make_catalog(spark, {{
        "college": [(1, "A")], "student_college_details": [enrol(s, 1) for s in students],
        "questionnaire_live": [(e, t) for e in range(1, 3001)],
        "questionnaire_live_has_students": [(5, e) for e in range(1, 3001)] + [(s, s % 3000 + 1) for s in students]}})
    rep1 = ReachReport(one, "2024-01-15", scope=[1])
    spec = [metric("total_live_assignment")]
    found = rep1.hot_links(spec)
    often = [i for h in found.values() for i in h["student_id"]]
    pairs = activity.of_students(activity.activity_pairs(one, spec, rep1.start, rep1.end, hot=found),
                                 rep1.members().select("student_id").distinct(), often)
    tasks = pairs.where("student_id = 5").groupBy(F.spark_partition_id().alias("p")).count().collect()
    out["student"] = [often, len(tasks), max(r["count"] for r in tasks),
                      rep1.metric_frame("total_live_assignment").head().total_live_assignment]
    got = rep.metric_frame("total_live_assignment").collect()
    out["got"] = sorted((r.college_id, r.total_live_assignment) for r in got)
    print(json.dumps(out))
""")


def test_hot_activity_is_spread_in_a_plain_session(scratch):
    """One activity linked to every student, sort-merge joins and no skew
    settings: its links lie in many tasks after the join, so do the distinct
    pairs, no other activity is repeated, and the eligible students come before the
    dedupe.  The same for a student linked to a third of all activities."""
    script = os.path.join(scratch, "hot.py")
    with open(script, "w") as fh:
        fh.write(HOT.format(root=ROOT))
    proc = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    lines = [line for line in proc.stdout.splitlines() if line.startswith("{")]
    assert proc.returncode == 0 and lines, proc.stderr[-3000:]
    out = json.loads(lines[-1])
    for name in ("single", "wide"):
        tasks, most, merged, distinct, semi = out[name]
        assert tasks >= 8 and most <= 1200, (name, tasks, most)
        assert merged and distinct <= 400 and semi >= 1
    assert out["hot"] == [[1]]
    often, tasks, most, reached = out["student"]
    assert often == [5] and tasks >= 8 and most <= 400 and reached == 7000 - 1
    # even students are in college 1: 2000 on the hot activity + 285 multiples of 14
    assert out["got"] == [[1, 2285], [2, 2286]]


def test_eligible_students_come_before_the_dedupe(spark, stored):
    rep = ReachReport(Catalog.from_parquet(spark, stored), FIXTURE_AS_OF, scope=FIXTURE_SCOPE)
    lines = rep.counts(rep.report_specs)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dedupe = next(i for i, x in enumerate(lines) if "Aggregate [metric" in x and "event_id" in x)
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x and "student_id" in x)
    assert semi > dedupe  # deeper in the tree: it runs first


def test_builders_start_one_sketch_job_at_most(spark, stored):
    rep = ReachReport(Catalog.from_parquet(spark, stored), FIXTURE_AS_OF, scope=FIXTURE_SCOPE)
    rep.catalog.table("college")
    spark.sparkContext.setJobGroup("builder", "builder")
    try:
        for name in table_schemas():
            rep.catalog.table(name)  # reads the schemas
        tracker = spark.sparkContext.statusTracker()
        before = len(tracker.getJobIdsForGroup("builder"))
        rep.metric_frame("case_study_count"), rep.colleges(), rep.members()
        assert len(tracker.getJobIdsForGroup("builder")) == before
        rep.combined()  # the sketch of every source (its stages are jobs of their own)
        sketched = len(tracker.getJobIdsForGroup("builder"))
        assert sketched <= before + 2
        rep.combined(), rep.summary_with_total(), rep.diagnostics(), rep.metric_frame("total_attendance")
        assert len(tracker.getJobIdsForGroup("builder")) == sketched
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_bucketed_roster_skips_member_shuffles(spark, scratch):
    """A roster stored bucketed by student_id: the members dedupe and the
    members side of the join run without a shuffle."""
    from reachlens.operators import activity
    from reachlens.specs import report_metrics
    db = "rl_bucket_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/{db}'")
    try:
        bound = bound_catalog(spark, "/root/testdata/sf0.001")
        for name in table_schemas():
            writer = bound.table(name).write.mode("overwrite")
            if name == "student_college_details":
                writer = writer.bucketBy(8, "student_id").sortBy("student_id")
            writer.saveAsTable(f"{db}.{name}")
        cat = Catalog.from_tables(spark, db)
        rep = ReachReport(cat, FIXTURE_AS_OF, scope=FIXTURE_SCOPE)
        assert "Exchange" not in plan_text(rep.members())
        keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
        old = {k: spark.conf.get(k, None) for k in keys}
        for k in keys:
            spark.conf.set(k, "-1")
        try:
            pairs = activity.activity_pairs(cat, report_metrics(), rep.start, rep.end)
            joined = activity.college_counts(activity.per_member_counts(pairs), rep.members())
            text = plan_text(joined)
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        # only the per-member side is shuffled for the join with the members
        assert "SortMergeJoin" in text
        assert len(re.findall(r"Exchange hashpartitioning\(student_id#\d+L?, \d+\)", text)) == 1
        bucketed = ReachReport(cat, FIXTURE_AS_OF, scope=FIXTURE_SCOPE).summary_with_total()
        plain = ReachReport(bound, FIXTURE_AS_OF, scope=FIXTURE_SCOPE).summary_with_total()
        assert sorted(map(tuple, bucketed.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
