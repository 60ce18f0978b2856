"""Declarative metric registry.

A metric counts, per organisation ("college") and report date, the distinct
(activity id, member id) pairs where the member is an eligible enrolment of the
college and the activity falls inside the report window.  Each spec names where
the pairs come from; the operators in ``reachlens.operators`` turn the specs into
one Spark plan.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the original report for identical output).
#   * default college scope
#   * eligibility flags of an enrolment row: active_status = 1, test = 0,
#     temp_column_1 = 0
#   * report window: 08:00 of the day before the report date to 08:00 of the
#     report date, both ends inclusive
#   * module order: teach, engage, assess, track, analyse, remediate
#   * wide-report column order (the METRICS tuple below, in_report=True rows)
#   * total row labels: "Total", "-", "Overall Total"
#   * period label format: dd-Mon-YYYY (08:00 AM)
# ---------------------------------------------------------------------------
ACTIVE_COLLEGES = (9, 21, 27, 28, 29, 32, 36, 40, 41, 64, 65, 66, 67, 68, 69, 70,
                   71, 72, 73, 74, 75, 76, 77)
ELIGIBLE_FLAGS = (("active_status", 1), ("test", 0), ("temp_column_1", 0))
WINDOW_HOUR = 8
MODULES = ("teach", "engage", "assess", "track", "analyse", "remediate")
TOTAL_ROW_S_NO = "Total"
TOTAL_ROW_COLLEGE_ID = "-"
TOTAL_ROW_NAME = "Overall Total"


@dataclass(frozen=True)
class MetricSpec:
    """One activity-reach metric.

    column      output column name
    module      report module the metric rolls up into
    bridge      member-to-activity table (``student_id`` + ``bridge_fk``);
                None for the batch hop and for constant metrics
    bridge_fk   bridge column holding the activity id
    event       activity table (``id`` + time column + flags)
    time_col    column tested against the report window
    time_side   "event" when ``time_col`` is on the activity table, "bridge"
                when it is on the bridge row
    event_filter  extra SQL predicate on the activity table, or None
    hop         "batch": activities reach members through the enrolment's
                batch id (subject mapping -> assignment), not a bridge
    constant    value of a metric with no source (always this number)
    in_report   part of the wide report / module sums
    roster_on_bridge  the original query tests eligibility in the bridge ON
                clause instead of the enrolment ON clause (same result; only the
                literal SQL differs)
    """

    column: str
    module: str
    bridge: str | None = None
    bridge_fk: str | None = None
    event: str | None = None
    time_col: str | None = None
    time_side: str = "event"
    event_filter: str | None = None
    hop: str | None = None
    constant: int | None = None
    in_report: bool = True
    roster_on_bridge: bool = False

    @property
    def source_key(self) -> tuple:
        """Specs with the same key read the same rows and share one scan."""
        return (self.bridge, self.bridge_fk, self.event, self.time_col,
                self.time_side, self.hop)

    @property
    def student_keyed(self) -> bool:
        return self.bridge is not None and self.hop is None


# Report order: wide-report column order first, then the two metrics that are
# computed but kept out of the report.
METRICS: tuple[MetricSpec, ...] = (
    MetricSpec("total_attendance", "teach", "student_attendance", "faculty_class_hour_id",
               "faculty_class_hours", "entry_date"),
    MetricSpec("total_live_assignment", "engage", "questionnaire_live_has_students",
               "questionnaire_id", "questionnaire_live", "start_time"),
    MetricSpec("total_live_survey", "engage", "live_survey_submissions", "live_survey_id",
               "live_surveys", "start_time"),
    MetricSpec("total_notify_count", "engage", "notifications_has_students",
               "notifications_id", "notifications", "created_at"),
    MetricSpec("total_live_class_count", "engage", "video_conference_has_students",
               "video_conference_id", "video_conference", "start_time"),
    MetricSpec("total_projects_count", "engage", "academic_project_has_students",
               "academic_project_id", "academic_projects", "start_time"),
    MetricSpec("total_arena_count", "engage", "weekly_challenge_participants",
               "weekly_challenge_id", "weekly_challenge", "created_at"),
    MetricSpec("total_objective_count", "assess", "questionnaire_has_students",
               "questionnaire_id", "questionnaire", "start_time"),
    MetricSpec("total_Assignment_count", "assess", "questionnaire_subjective_has_students",
               "questionnaire_id", "questionnaire_subjective", "start_time",
               event_filter="is_assignment = 1"),
    MetricSpec("total_subjective_count", "assess", "questionnaire_subjective_has_students",
               "questionnaire_id", "questionnaire_subjective", "start_time",
               event_filter="is_assignment = 0"),
    MetricSpec("total_coding_count", "assess", "coding_test_has_students", "test_id",
               "coding_test", "start_time"),
    MetricSpec("total_faculty_feedback", "track", "faculty_feedback_students", "feedback_id",
               "faculty_feedback", "start_time"),
    MetricSpec("total_semester_feedback", "track", "semester_feedback_has_students",
               "semester_feedback_id", "semester_feedback", "start_time",
               roster_on_bridge=True),
    MetricSpec("total_regular_feedback", "track", "survey_has_students", "survey_id",
               "survey", "start_time"),
    MetricSpec("swoc_count", "analyse", constant=0),
    MetricSpec("total_remediate_count", "remediate", "questionnaire_remedial_path",
               "questionnaire_id", "questionnaire", "created_at", time_side="bridge",
               event_filter="remedial_path = 1"),
    # computed by the original report but never merged into it
    MetricSpec("case_study_count", "engage", event="case_study_assignments",
               time_col="start_date", hop="batch", in_report=False),
    # disabled in the original report
    MetricSpec("go_code_count", "engage", "student_coding_track_question_submissions",
               "question_id", "coding_track_questions", "created_at", time_side="bridge",
               in_report=False),
)

_BY_COLUMN = {m.column: m for m in METRICS}


def metric(column: str) -> MetricSpec:
    return _BY_COLUMN[column]


def report_metrics() -> tuple[MetricSpec, ...]:
    """Metrics of the wide report, in column order."""
    return tuple(m for m in METRICS if m.in_report)


def module_metrics(module: str) -> tuple[MetricSpec, ...]:
    """Metrics of one module frame, in that frame's column order."""
    return tuple(m for m in report_metrics() if m.module == module)


# Tables the specs read, with the columns and Spark types they need.  Sources
# cast to these types on load so every operator sees one schema.
ROSTER_SCHEMAS = {
    "college": {"id": "bigint", "college_name": "string"},
    "student_college_details": {
        "student_id": "bigint", "college_id": "bigint", "active_status": "int",
        "test": "int", "temp_column_1": "int", "regulation_batch_mapping_id": "bigint"},
    "college_subject_mapping": {"id": "bigint", "regulation_batch_mapping_id": "bigint"},
}
# Activity flags the metric filters test.
FLAG_COLUMNS = {
    "questionnaire": {"remedial_path": "int"},
    "questionnaire_subjective": {"is_assignment": "int"},
}


def table_schemas() -> dict[str, dict[str, str]]:
    """Column -> type for every table the registry touches (time columns are
    typed by the source: DATE or TIMESTAMP_NTZ)."""
    schemas: dict[str, dict[str, str]] = {k: dict(v) for k, v in ROSTER_SCHEMAS.items()}
    for m in METRICS:
        if m.bridge:
            cols = schemas.setdefault(m.bridge, {"student_id": "bigint"})
            cols[m.bridge_fk] = "bigint"
            if m.time_side == "bridge":
                cols[m.time_col] = "time"
        if m.event:
            cols = schemas.setdefault(m.event, {"id": "bigint"})
            if m.time_side == "event":
                cols[m.time_col] = "time"
            if m.hop == "batch":
                cols["college_subject_mapping_id"] = "bigint"
    for table, cols in FLAG_COLUMNS.items():
        schemas.setdefault(table, {"id": "bigint"}).update(cols)
    return schemas
