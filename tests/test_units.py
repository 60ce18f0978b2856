"""Handwritten rows for the semantic edge cases (FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from helpers import enrol, make_catalog, ts
from reachlens.plans import ReachReport

AS_OF = "2024-01-15"
LIVE = "total_live_assignment"


def counts(report, column, by="college_id"):
    return {r[by]: r[column] for r in report.metric_frame(column).collect()}


def live_catalog(spark, events, links, enrolments, colleges=((9, "C9"),)):
    return make_catalog(spark, {
        "college": list(colleges),
        "student_college_details": enrolments,
        "questionnaire_live": events,
        "questionnaire_live_has_students": links,
    })


def test_window_bounds_are_closed(spark):
    events = [(1, ts("2024-01-14 08:00:00")), (2, ts("2024-01-15 08:00:00")),
              (3, ts("2024-01-14 07:59:59.999999")), (4, ts("2024-01-15 08:00:00.000001")),
              (5, ts("2024-01-14 08:00:00.000001")), (6, ts("2024-01-15 07:59:59.999999"))]
    cat = live_catalog(spark, events, [(1, i) for i in range(1, 7)], [enrol(1, 9)])
    assert counts(ReachReport(cat, AS_OF, scope=[9]), LIVE) == {9: 4}


def test_boundary_event_counts_for_two_report_dates(spark):
    cat = live_catalog(spark, [(1, ts("2024-01-15 08:00:00"))], [(1, 1)], [enrol(1, 9)])
    rows = ReachReport(cat, "2024-01-14", "2024-01-16", scope=[9]).metric_frame(LIVE).collect()
    assert {r.report_date.isoformat(): r[LIVE] for r in rows} == {
        "2024-01-14": 0, "2024-01-15": 1, "2024-01-16": 1}


def test_one_day_equals_slice_of_range(spark):
    events = [(i, ts("2024-01-13 06:00:00") + dt.timedelta(hours=7 * i)) for i in range(12)]
    links = [(s, i) for i in range(12) for s in (1, 2) if (i + s) % 3]
    cat = live_catalog(spark, events, links, [enrol(1, 9), enrol(2, 9)])
    span = {r.report_date: r[LIVE] for r in
            ReachReport(cat, "2024-01-13", "2024-01-16", scope=[9]).metric_frame(LIVE).collect()}
    for day, n in span.items():
        assert counts(ReachReport(cat, day, scope=[9]), LIVE) == {9: n}


def test_date_column_counts_only_on_its_own_date(spark):
    cat = make_catalog(spark, {
        "college": [(9, "C9")],
        "student_college_details": [enrol(1, 9)],
        "faculty_class_hours": [(1, dt.date(2024, 1, 14)), (2, dt.date(2024, 1, 15)),
                                (3, dt.date(2024, 1, 16))],
        "student_attendance": [(1, 1), (1, 2), (1, 3)],
    }, time_types={"faculty_class_hours": {"entry_date": T.DateType()}})
    assert counts(ReachReport(cat, AS_OF, scope=[9]), "total_attendance") == {9: 1}


def test_null_time_and_flag_split(spark):
    t = ts("2024-01-15 01:00:00")
    cat = make_catalog(spark, {
        "college": [(9, "C9")],
        "student_college_details": [enrol(1, 9)],
        "questionnaire_subjective": [(1, t, 0), (2, t, 1), (3, None, 0), (4, None, 1), (5, t, 0)],
        "questionnaire_subjective_has_students": [(1, i) for i in range(1, 6)],
    })
    rep = ReachReport(cat, AS_OF, scope=[9])
    assert counts(rep, "total_subjective_count") == {9: 2}
    assert counts(rep, "total_Assignment_count") == {9: 1}


def test_duplicate_bridge_rows_count_once(spark):
    t = ts("2024-01-15 01:00:00")
    cat = live_catalog(spark, [(1, t)], [(1, 1), (1, 1), (1, 1)], [enrol(1, 9)])
    assert counts(ReachReport(cat, AS_OF, scope=[9]), LIVE) == {9: 1}


def test_double_enrolment_same_and_two_colleges(spark):
    t = ts("2024-01-15 01:00:00")
    cat = live_catalog(spark, [(1, t)], [(1, 1), (2, 1)],
                       [enrol(1, 9), enrol(1, 9), enrol(2, 9), enrol(2, 21)],
                       colleges=[(9, "C9"), (21, "C21")])
    rep = ReachReport(cat, AS_OF, scope=[9, 21])
    assert counts(rep, LIVE) == {9: 2, 21: 1}
    total = [r for r in rep.summary_with_total().collect() if r.is_total][0]
    assert total.engage == 3 and total.total == 3


def test_batch_hop_takes_batch_from_eligible_row(spark):
    t = ts("2024-01-15 01:00:00")
    cat = make_catalog(spark, {
        "college": [(9, "C9")],
        "student_college_details": [enrol(1, 9, batch=100), enrol(1, 9, active=0, batch=200)],
        "college_subject_mapping": [(1, 100), (2, 200)],
        "case_study_assignments": [(10, t, 1), (20, t, 2)],
    })
    assert counts(ReachReport(cat, AS_OF, scope=[9]), "case_study_count") == {9: 1}


def test_batch_hop_student_with_two_batches(spark):
    t = ts("2024-01-15 01:00:00")
    cat = make_catalog(spark, {
        "college": [(9, "C9")],
        "student_college_details": [enrol(1, 9, batch=100), enrol(1, 9, batch=200),
                                    enrol(2, 9, batch=100)],
        "college_subject_mapping": [(1, 100), (2, 200), (3, 200)],
        # assignment 10 is mapped twice (to both batches): counted once per student
        "case_study_assignments": [(10, t, 1), (10, t, 2), (20, t, 2), (30, t, 3)],
    })
    # student 1: {10, 20, 30} ; student 2: {10}
    assert counts(ReachReport(cat, AS_OF, scope=[9]), "case_study_count") == {9: 4}


@pytest.mark.parametrize("row", [enrol(1, 9, active=0), enrol(1, 9, test=1),
                                 enrol(1, 9, temp=1), (1, 9, None, 0, 0, None)])
def test_ineligible_rows_do_not_count(spark, row):
    t = ts("2024-01-15 01:00:00")
    cat = live_catalog(spark, [(1, t)], [(1, 1)], [row])
    assert counts(ReachReport(cat, AS_OF, scope=[9]), LIVE) == {9: 0}


def test_null_college_name_is_kept(spark):
    t = ts("2024-01-15 01:00:00")
    cat = live_catalog(spark, [(1, t)], [(1, 1)], [enrol(1, 9)], colleges=[(9, None)])
    rows = ReachReport(cat, AS_OF, scope=[9]).combined().collect()
    assert len(rows) == 1 and rows[0].college_name is None and rows[0][LIVE] == 1


def test_scope_missing_single_and_empty(spark):
    t = ts("2024-01-15 01:00:00")
    cat = live_catalog(spark, [(1, t)], [(1, 1)], [enrol(1, 9), enrol(1, 76)])
    assert counts(ReachReport(cat, AS_OF, scope=[9, 76, 77]), LIVE) == {9: 1}
    assert counts(ReachReport(cat, AS_OF, scope=[9]), LIVE) == {9: 1}
    empty = live_catalog(spark, [(1, t)], [(1, 1)], [enrol(1, 9)], colleges=[])
    rows = ReachReport(empty, AS_OF, scope=[9]).summary_with_total().collect()
    assert len(rows) == 1 and rows[0].is_total and rows[0].total == 0
    assert rows[0].s_no == "Total" and rows[0].college_name == "Overall Total"


def test_constant_module_is_zero(spark):
    cat = live_catalog(spark, [], [], [enrol(1, 9)], colleges=[(9, "C9"), (21, "C21")])
    rows = ReachReport(cat, AS_OF, scope=[9, 21]).combined().collect()
    assert [r.swoc_count for r in rows] == [0, 0]


def test_logged_totals_include_college_ids(spark):
    t = ts("2024-01-15 01:00:00")
    cat = live_catalog(spark, [(1, t), (2, t)], [(1, 1), (2, 1), (2, 2)],
                       [enrol(1, 1), enrol(2, 2)], colleges=[(1, "A"), (2, "B")])
    d = ReachReport(cat, AS_OF, scope=[1, 2]).diagnostics().collect()[0]
    assert d.engage_total == 3 and d.engage_logged_total == 6
    assert d.colleges_processed == 2 and d.total_activities == 3
    assert d.total_activities_text == "3"


def test_remediation_flag_and_bridge_time(spark):
    inside, outside = ts("2024-01-15 01:00:00"), ts("2024-01-16 01:00:00")
    cat = make_catalog(spark, {
        "college": [(9, "C9")],
        "student_college_details": [enrol(1, 9)],
        "questionnaire": [(1, None, 1), (2, None, 0)],
        "questionnaire_remedial_path": [(1, 1, inside), (1, 2, inside), (1, 1, outside),
                                        (1, 2, outside)],
    })
    assert counts(ReachReport(cat, AS_OF, scope=[9]), "total_remediate_count") == {9: 1}


def test_rank_ties_break_by_college_id(spark):
    t = ts("2024-01-15 01:00:00")
    cat = live_catalog(spark, [(1, t)], [(1, 1), (2, 1), (3, 1)],
                       [enrol(1, 30), enrol(2, 20), enrol(3, 10), enrol(3, 20)],
                       colleges=[(10, "X"), (20, "Y"), (30, "Z")])
    rows = ReachReport(cat, AS_OF, scope=[10, 20, 30]).summary().collect()
    assert [(r.s_no, r.college_id, r.total) for r in sorted(rows, key=lambda r: r.s_no)] == [
        (1, 20, 2), (2, 10, 1), (3, 30, 1)]


def test_period_labels(spark):
    cat = live_catalog(spark, [], [], [enrol(1, 9)])
    p = ReachReport(cat, AS_OF, scope=[9]).period().collect()[0]
    assert p.period_start_label == "14-Jan-2024 (08:00 AM)"
    assert p.period_end_label == "15-Jan-2024 (08:00 AM)"
    assert p.window_start == dt.datetime(2024, 1, 14, 8)


def test_string_times_are_normalised_and_bad_values_do_not_count(spark):
    from reachlens.sources.catalog import Catalog
    base = make_catalog(spark, {"college": [(9, "C9")],
                                "student_college_details": [enrol(1, 9)],
                                "questionnaire_live_has_students": [(1, 1), (1, 2), (1, 3)]})
    events = spark.createDataFrame(
        [(1, "2024-01-15 01:00:00"), (2, "0000-00-00 00:00:00"), (3, "2024-01-14 07:00:00")],
        "id bigint, start_time string")
    frames = {n: base.table(n) for n in base.names()}
    frames["questionnaire_live"] = events
    cat = Catalog.from_frames(spark, frames)
    assert counts(ReachReport(cat, AS_OF, scope=[9]), LIVE) == {9: 1}


def test_custom_spec_list_drives_the_report(spark):
    from reachlens.specs import metric
    t = ts("2024-01-15 01:00:00")
    cat = live_catalog(spark, [(1, t)], [(1, 1)], [enrol(1, 9)])
    rep = ReachReport(cat, AS_OF, scope=[9], specs=[metric(LIVE), metric("swoc_count")])
    assert rep.combined().columns == ["report_date", "s_no", "college_id", "college_name",
                                      LIVE, "swoc_count"]
    row = rep.summary().collect()[0]
    assert (row.engage, row.teach, row.total) == (1, 0, 1)


def test_a_scope_table_equals_the_list(spark):
    """A semi join against a table of ids (repeated, null and absent ones too) gives what
    the literal list gives, in every output."""
    t = ts("2024-01-15 01:00:00")
    cat = make_catalog(spark, {
        "college": [(1, "A"), (2, "B"), (3, "C"), (4, None)],
        "student_college_details": [enrol(s, 1 + s % 4, batch=s % 3) for s in range(1, 60)] + [enrol(5, 3, batch=1)],
        "questionnaire_live": [(e, t) for e in range(1, 6)],
        "questionnaire_live_has_students": [(s, 1 + s % 5) for s in range(1, 60)],
        "college_subject_mapping": [(1, 0), (2, 1), (3, 2)],
        "case_study_assignments": [(a, t, 1 + a % 3) for a in range(10)]})
    table = spark.createDataFrame([(1,), (3,), (3,), (None,), (99,), (4,)], "college_id int")
    listed, joined = (ReachReport(cat, "2024-01-15", scope=s) for s in ([1, 3, 99, 4], table))
    for make in (lambda r: r.combined(), lambda r: r.summary_with_total(), lambda r: r.diagnostics(),
                 lambda r: r.metric_frame("case_study_count"), lambda r: r.metric_frame("total_live_assignment")):
        a, b = make(listed), make(joined)
        assert a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    plan = joined.metric_frame("total_live_assignment")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and " IN (" not in plan
    empty = ReachReport(cat, "2024-01-15", scope=table.limit(0))
    assert empty.combined().collect() == []
    assert [r.total for r in empty.summary_with_total().collect()] == [0]
