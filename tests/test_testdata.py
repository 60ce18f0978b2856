"""Whole-table checks on the driver's test data: checked totals and the DuckDB
oracle for every registered query."""

import re

import pytest
from pyspark.sql import functions as F

from reachlens.plans import ReachReport
from reachlens.sources.bindings import FIXTURE_AS_OF, FIXTURE_SCOPE, bound_catalog
from reachlens.specs import METRICS

# Checked totals over the 23 colleges for report date 2024-01-15 (FIXTURES.md §3).
EXPECTED = {
    "sf0.001": {"total_attendance": 25, "total_live_assignment": 5, "total_live_survey": 4,
                "total_notify_count": 17, "total_live_class_count": 10,
                "total_projects_count": 1, "total_arena_count": 4,
                "total_objective_count": 18, "total_Assignment_count": 6,
                "total_subjective_count": 3, "total_coding_count": 8,
                "total_faculty_feedback": 10, "total_semester_feedback": 11,
                "total_regular_feedback": 16, "swoc_count": 0, "total_remediate_count": 11,
                "case_study_count": 14, "go_code_count": 3},
    "sf0.01": {"total_attendance": 222, "total_live_assignment": 63, "total_live_survey": 79,
               "total_notify_count": 77, "total_live_class_count": 75,
               "total_projects_count": 81, "total_arena_count": 40,
               "total_objective_count": 118, "total_Assignment_count": 71,
               "total_subjective_count": 37, "total_coding_count": 131,
               "total_faculty_feedback": 102, "total_semester_feedback": 109,
               "total_regular_feedback": 162, "swoc_count": 0, "total_remediate_count": 119,
               "case_study_count": 1944, "go_code_count": 52},
    "sf0.1": {"total_attendance": 2254, "total_live_assignment": 735, "total_live_survey": 733,
              "total_notify_count": 756, "total_live_class_count": 723,
              "total_projects_count": 758, "total_arena_count": 471,
              "total_objective_count": 1202, "total_Assignment_count": 685,
              "total_subjective_count": 338, "total_coding_count": 1287,
              "total_faculty_feedback": 1077, "total_semester_feedback": 1049,
              "total_regular_feedback": 1573, "swoc_count": 0, "total_remediate_count": 1160,
              "case_study_count": 175338, "go_code_count": 478},
}
TOTAL_ROW = {"sf0.001": (25, 41, 35, 37, 0, 11, 149), "sf0.01": (222, 415, 357, 373, 0, 119, 1486),
             "sf0.1": (2254, 4176, 3512, 3699, 0, 1160, 14801)}
RANK_ONE = {"sf0.001": ("NATION_11", 15), "sf0.01": ("NATION_24", 110), "sf0.1": ("NATION_2", 741)}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_checked_totals(spark, sf):
    rep = ReachReport(bound_catalog(spark, f"/root/testdata/{sf}"), FIXTURE_AS_OF,
                      scope=FIXTURE_SCOPE)
    wide = rep.wide(METRICS)
    got = wide.agg(*[F.sum(m.column).alias(m.column) for m in METRICS]).collect()[0].asDict()
    assert got == EXPECTED[sf]
    rows = rep.summary_with_total().collect()
    assert len(rows) == 24
    total = [r for r in rows if r.is_total][0]
    assert (total.teach, total.engage, total.assess, total.track, total.analyse,
            total.remediate, total.total) == TOTAL_ROW[sf]
    first = [r for r in rows if r.s_no == "1"][0]
    assert (first.college_name, first.total) == RANK_ONE[sf]


def report_queries():
    """The report's queries (the numbered ones and the pipeline have tests of their own)."""
    import __spark_entry__ as E
    return [q for q in E.queries() if not re.match(r"op\d+_|pipeline$", q)]


def test_oracle_all_queries_sf0001(spark):
    from oracle_check import compare
    report = compare(spark, "/root/testdata/sf0.001", report_queries())
    bad = {k: v for k, v in report.items()
           if not (v.get("columns_match", True) and v.get("values_match", True)
                   and v.get("types_match", True))}
    assert not bad, bad
    assert all("oracle_rows" in v for v in report.values())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 24 and df.columns[0] == "s_no"
    assert set(report_queries()) <= set(E.oracle_sql())
