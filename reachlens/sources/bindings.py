"""Binding of the report's tables to the driver's generic test tables.

The test data has no learning-platform tables, so each one is defined as a view
over ``nation``/``customer``/``orders``/``events``/``part`` (FIXTURES.md §2).
Every view is written once as SQL with two small dialect hooks; Spark runs it
through ``spark.sql`` over the raw parquet tables registered as temp views, and
the DuckDB oracle uses the same text as a CTE.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from reachlens.sources.catalog import Catalog
from reachlens.specs import MetricSpec

# Fixture parameters (FIXTURES.md §2): report date and scope for the test data.
FIXTURE_AS_OF = "2024-01-15"
FIXTURE_SCOPE = tuple([i for i in range(1, 25) if i != 13] + [76, 77])
FIXTURE_RANGE = ("2024-01-01", "2024-01-31")
FAMILY_BASE = "2024-01-01"

RAW_TABLES = ("nation", "customer", "orders", "events", "part", "lineitem")

# activity table -> (bridge table, bridge fk column, time column, predicate on orders)
ORDER_FAMILIES = {
    "questionnaire_live": ("questionnaire_live_has_students", "questionnaire_id",
                           "start_time", "o_orderpriority = '1-URGENT'"),
    "live_surveys": ("live_survey_submissions", "live_survey_id", "start_time",
                     "o_orderpriority = '2-HIGH'"),
    "notifications": ("notifications_has_students", "notifications_id", "created_at",
                      "o_orderpriority = '3-MEDIUM'"),
    "video_conference": ("video_conference_has_students", "video_conference_id",
                         "start_time", "o_orderpriority = '4-NOT SPECIFIED'"),
    "academic_projects": ("academic_project_has_students", "academic_project_id",
                          "start_time", "o_orderpriority = '5-LOW'"),
    "questionnaire": ("questionnaire_has_students", "questionnaire_id", "start_time",
                      "o_orderstatus = 'F'"),
    "questionnaire_subjective": ("questionnaire_subjective_has_students", "questionnaire_id",
                                 "start_time", "o_orderstatus = 'O'"),
    "coding_test": ("coding_test_has_students", "test_id", "start_time",
                    "o_orderstatus = 'P'"),
    "faculty_feedback": ("faculty_feedback_students", "feedback_id", "start_time",
                         "o_orderkey % 7 < 2"),
    "semester_feedback": ("semester_feedback_has_students", "semester_feedback_id",
                          "start_time", "o_orderkey % 7 IN (2, 3)"),
    "survey": ("survey_has_students", "survey_id", "start_time", "o_orderkey % 7 > 3"),
}
#: a metric of the test data whose activities grow with it (not in the report)
GROWING = MetricSpec("order_reach", "teach", "order_activity_students", "order_id",
                     "order_activities", "start_time", in_report=False)
EVENT_EXTRAS = {
    "questionnaire": ", id % 2 AS remedial_path",
    "questionnaire_subjective": ", id % 2 AS is_assignment",
}


def _family_time(dialect: str) -> str:
    """Activity time of id: base + (id % 30) days + (id div 30) hours."""
    if dialect == "spark":
        return (f"timestamp_ntz'{FAMILY_BASE} 00:00:00' + "
                "make_dt_interval(CAST(id % 30 AS INT), CAST(id DIV 30 AS INT))")
    return (f"TIMESTAMP '{FAMILY_BASE} 00:00:00' + to_days(CAST(id % 30 AS INTEGER)) "
            "+ to_hours(CAST(id // 30 AS INTEGER))")


def _order_time(dialect: str) -> str:
    """Like the family time, over 31 days and every hour: id % 31 days and
    (id div 31) % 24 hours after the base."""
    if dialect == "spark":
        return (f"timestamp_ntz'{FAMILY_BASE} 00:00:00' + "
                "make_dt_interval(CAST(id % 31 AS INT), CAST((id DIV 31) % 24 AS INT))")
    return (f"TIMESTAMP '{FAMILY_BASE} 00:00:00' + to_days(CAST(id % 31 AS INTEGER)) "
            "+ to_hours(CAST((id // 31) % 24 AS INTEGER))")


def _family_date(dialect: str) -> str:
    if dialect == "spark":
        return f"date_add(DATE'{FAMILY_BASE}', CAST(id % 30 AS INT))"
    return f"CAST(DATE '{FAMILY_BASE}' + CAST(id % 30 AS INTEGER) AS DATE)"


def binding_sql(dialect: str) -> dict[str, str]:
    """Reference table -> SELECT over raw tables written as ``{orders}`` etc."""
    views = {
        "college": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS college_name "
                   "FROM {nation}",
        "student_college_details": (
            "SELECT c_custkey AS student_id, CAST(c_nationkey AS BIGINT) AS college_id, "
            "CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS active_status, "
            "CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END AS test, "
            "CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END AS temp_column_1, "
            "c_custkey % 40 AS regulation_batch_mapping_id FROM {customer}"),
        "weekly_challenge_participants": (
            "SELECT user_id AS student_id, event_id AS weekly_challenge_id "
            "FROM {events} WHERE event_type = 'click'"),
        "weekly_challenge": "SELECT event_id AS id, ts AS created_at FROM {events} "
                            "WHERE event_type = 'click'",
        "student_attendance": "SELECT user_id AS student_id, event_id % 720 AS "
                              "faculty_class_hour_id FROM {events}",
        "faculty_class_hours": (
            f"SELECT id, {_family_date(dialect)} AS entry_date FROM "
            "(SELECT DISTINCT event_id % 720 AS id FROM {events}) t"),
        "college_subject_mapping": (
            "SELECT p_partkey AS id, p_partkey % 40 AS regulation_batch_mapping_id "
            "FROM {part}"),
        "case_study_assignments": (
            "SELECT event_id AS id, event_id % (SELECT max(p_partkey) + 1 FROM {part}) "
            "AS college_subject_mapping_id, ts AS start_date FROM {events} "
            "WHERE event_type = 'error'"),
        # an activity side that grows with the data: an activity an order, a
        # link an order line
        "order_activities": (
            f"SELECT id, {_order_time(dialect)} AS start_time "
            "FROM (SELECT o_orderkey AS id FROM {orders}) t"),
        "order_activity_students": "SELECT l_partkey AS student_id, l_orderkey AS order_id "
                                   "FROM {lineitem}",
        "questionnaire_remedial_path": (
            "SELECT user_id AS student_id, event_id % 720 AS questionnaire_id, "
            "ts AS created_at FROM {events}"),
        "coding_track_questions": "SELECT DISTINCT event_id % 50 AS id FROM {events} "
                                  "WHERE event_type = 'signup'",
        "student_coding_track_question_submissions": (
            "SELECT user_id AS student_id, event_id % 50 AS question_id, "
            "ts AS created_at FROM {events} WHERE event_type = 'signup'"),
    }
    for event, (bridge, fk, time_col, pred) in ORDER_FAMILIES.items():
        views[bridge] = (f"SELECT o_custkey AS student_id, o_orderkey % 720 AS {fk} "
                         f"FROM {{orders}} WHERE {pred}")
        time_expr = _family_time(dialect)
        if event == "questionnaire_subjective":
            time_expr = f"CASE WHEN id % 7 = 0 THEN NULL ELSE {time_expr} END"
        views[event] = (f"SELECT id, {time_expr} AS {time_col}{EVENT_EXTRAS.get(event, '')} "
                        f"FROM (SELECT DISTINCT o_orderkey % 720 AS id FROM {{orders}} "
                        f"WHERE {pred}) t")
    return views


_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def raw_tables_of(sql: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(sql)))


def duckdb_ctes(tables: list[str] | None = None) -> str:
    """``WITH`` clause defining the bound tables for DuckDB (raw tables are
    pre-registered views there)."""
    views = binding_sql("duckdb")
    names = tables if tables is not None else list(views)
    parts = [f"{n} AS ({views[n].format(**{t: t for t in RAW_TABLES})})" for n in names]
    return "WITH " + ",\n".join(parts)


def bound_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """Catalog over the driver's parquet tables in ``sf_dir``.

    Each raw table is read once and registered as a temp view with a name
    unique to this catalog; the binding SQL refers to those views."""
    tag = uuid.uuid4().hex[:12]
    registered: dict[str, str] = {}

    def view(name: str) -> str:
        if name not in registered:
            registered[name] = f"rl_{tag}_{name}"
            spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") \
                .createOrReplaceTempView(registered[name])
        return registered[name]

    views = binding_sql("spark")

    def loader(sql: str):
        return lambda: spark.sql(sql.format(**{t: view(t) for t in raw_tables_of(sql)}))

    return Catalog(spark, {name: loader(sql) for name, sql in views.items()})
