"""Literal SQL of the original report, for cross-checking in DuckDB.

Each metric is rendered the way the original queries are written: college LEFT
JOIN enrolment LEFT JOIN bridge LEFT JOIN activity with the window in the ON
clause, COUNT(DISTINCT id || '-' || student) per college.  Nothing here is
used by the Spark plans; it is the independent oracle they are compared with
(the Spark side counts per member and joins inner, see ``operators.activity``).

A report-dates CTE generalises the one-day query to a date range: the window
bounds come from each date row, so the same text checks the backfill.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from reachlens.functions.timewin import as_date
from reachlens.sources.bindings import duckdb_ctes
from reachlens.specs import (ELIGIBLE_FLAGS, MODULES, TOTAL_ROW_COLLEGE_ID, TOTAL_ROW_NAME,
                             TOTAL_ROW_S_NO, WINDOW_HOUR, MetricSpec, module_metrics,
                             report_metrics)


def _scope_list(scope: Iterable[int]) -> str:
    return "(" + ", ".join(str(int(x)) for x in scope) + ")"


def _flags(alias: str) -> str:
    return " AND ".join(f"{alias}.{c} = {v}" for c, v in ELIGIBLE_FLAGS)


def report_dates_cte(start, end) -> str:
    start, end = as_date(start), as_date(end)
    return ("report_dates AS (SELECT CAST(x AS DATE) AS report_date, "
            f"CAST(x AS DATE) - INTERVAL {24 - WINDOW_HOUR} HOURS AS lo, "
            f"CAST(x AS DATE) + INTERVAL {WINDOW_HOUR} HOURS AS hi "
            f"FROM range(DATE '{start}', DATE '{end}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(x))")


def tables_of(specs: Sequence[MetricSpec]) -> list[str]:
    names = ["college", "student_college_details"]
    for s in specs:
        for t in (s.bridge, s.event):
            if t and t not in names:
                names.append(t)
        if s.hop == "batch" and "college_subject_mapping" not in names:
            names.append("college_subject_mapping")
    return names


def metric_select(spec: MetricSpec, scope: Iterable[int]) -> str:
    """(report_date, college_id, college_name, <column>) for one metric."""
    head = ("SELECT d.report_date, CAST(c.id AS BIGINT) AS college_id, c.college_name, ")
    src = f"FROM report_dates d JOIN college c ON c.id IN {_scope_list(scope)} "
    tail = " GROUP BY d.report_date, c.id, c.college_name"
    if spec.constant is not None:
        return head + f"CAST({spec.constant} AS BIGINT) AS {spec.column} " + src
    pair = ("COUNT(DISTINCT CAST(e.id AS VARCHAR) || '-' || CAST(scd.student_id AS VARCHAR))"
            f" AS {spec.column} ")
    if spec.roster_on_bridge:
        roster = "LEFT JOIN student_college_details scd ON scd.college_id = c.id "
        bridge_extra = f" AND {_flags('scd')}"
    else:
        roster = f"LEFT JOIN student_college_details scd ON scd.college_id = c.id AND {_flags('scd')} "
        bridge_extra = ""
    if spec.hop == "batch":
        t = spec.time_col
        joins = ("LEFT JOIN college_subject_mapping csm ON csm.regulation_batch_mapping_id = "
                 "scd.regulation_batch_mapping_id "
                 f"LEFT JOIN {spec.event} e ON e.college_subject_mapping_id = csm.id "
                 f"AND e.{t} IS NOT NULL AND e.{t} BETWEEN d.lo AND d.hi")
    else:
        side = "e" if spec.time_side == "event" else "b"
        cond = [f"e.id = b.{spec.bridge_fk}"]
        if spec.event_filter:
            cond.append(f"e.{spec.event_filter}")
        cond.append(f"{side}.{spec.time_col} IS NOT NULL")
        cond.append(f"{side}.{spec.time_col} BETWEEN d.lo AND d.hi")
        joins = (f"LEFT JOIN {spec.bridge} b ON b.student_id = scd.student_id{bridge_extra} "
                 f"LEFT JOIN {spec.event} e ON " + " AND ".join(cond))
    return head + pair + src + roster + joins + tail


def with_clause(specs: Sequence[MetricSpec], start, end, scope, extra: Sequence[str] = ()) -> str:
    ctes = duckdb_ctes(tables_of(specs))
    parts = [report_dates_cte(start, end)]
    parts += [f"m_{s.column} AS ({metric_select(s, scope)})" for s in specs]
    frame_cols = ", ".join(f"COALESCE(m_{s.column}.{s.column}, 0) AS {s.column}" for s in specs)
    joins = " ".join(f"LEFT JOIN m_{s.column} ON m_{s.column}.report_date = f.report_date "
                     f"AND m_{s.column}.college_id = f.college_id" for s in specs)
    parts.append("frame AS (SELECT d.report_date, CAST(c.id AS BIGINT) AS college_id, "
                 f"c.college_name FROM report_dates d JOIN college c ON c.id IN "
                 f"{_scope_list(scope)})")
    parts.append(f"wide AS (SELECT f.report_date, f.college_id, f.college_name, {frame_cols} "
                 f"FROM frame f {joins})")
    parts += list(extra)
    return ctes + ",\n" + ",\n".join(parts)


def _q(name: str) -> str:
    """Quoted identifier (module names include DuckDB keywords)."""
    return f'"{name}"'


def _mods(values=MODULES) -> str:
    return ", ".join(_q(m) for m in values)


def _cols(specs: Sequence[MetricSpec]) -> str:
    return ", ".join(s.column for s in specs)


def _date_col(keep_date: bool) -> str:
    return "report_date, " if keep_date else ""


def wide_sql(specs: Sequence[MetricSpec], start, end, scope, keep_date: bool) -> str:
    return (with_clause(specs, start, end, scope) +
            f"\nSELECT {_date_col(keep_date)}college_id, college_name, {_cols(specs)} FROM wide")


def metric_sql(spec: MetricSpec, start, end, scope, keep_date: bool = False) -> str:
    return wide_sql([spec], start, end, scope, keep_date)


def module_sql(module: str, start, end, scope, keep_date: bool = False) -> str:
    return wide_sql(module_metrics(module), start, end, scope, keep_date)


def combined_sql(start, end, scope, keep_date: bool = False) -> str:
    specs = report_metrics()
    return (with_clause(specs, start, end, scope) +
            f"\nSELECT {_date_col(keep_date)}CAST(row_number() OVER (PARTITION BY report_date "
            f"ORDER BY college_id) AS BIGINT) AS s_no, college_id, college_name, {_cols(specs)} "
            "FROM wide")


def _scored_cte() -> str:
    specs = report_metrics()
    scores = []
    for m in MODULES:
        cols = [s.column for s in specs if s.module == m]
        scores.append(f"CAST({' + '.join(cols) if cols else '0'} AS BIGINT) AS {_q(m)}")
    total = " + ".join(_q(m) for m in MODULES)
    return (f"scored AS (SELECT report_date, college_id, college_name, {', '.join(scores)} "
            f"FROM wide), scored_total AS (SELECT *, CAST({total} AS BIGINT) AS total "
            "FROM scored)")


def summary_sql(start, end, scope, keep_date: bool = False) -> str:
    return (with_clause(report_metrics(), start, end, scope, [_scored_cte()]) +
            f"\nSELECT {_date_col(keep_date)}CAST(row_number() OVER (PARTITION BY report_date "
            "ORDER BY total DESC, college_id) AS BIGINT) AS s_no, college_id, college_name, "
            f"{_mods()}, total FROM scored_total")


def summary_total_sql(start, end, scope, keep_date: bool = False) -> str:
    values = (*MODULES, "total")
    sums = ", ".join(f"CAST(COALESCE(SUM(s.{_q(m)}), 0) AS BIGINT) AS {_q(m)}" for m in values)
    dc = _date_col(keep_date)
    ranked = (f"SELECT {dc}CAST(row_number() OVER (PARTITION BY report_date ORDER BY total DESC, "
              "college_id) AS VARCHAR) AS s_no, CAST(college_id AS VARCHAR) AS college_id, "
              f"college_name, {_mods(values)} FROM scored_total")
    dsel = "d.report_date, " if keep_date else ""
    total = (f"SELECT {dsel}'{TOTAL_ROW_S_NO}' AS s_no, '{TOTAL_ROW_COLLEGE_ID}' AS college_id, "
             f"'{TOTAL_ROW_NAME}' AS college_name, {sums} FROM report_dates d "
             "LEFT JOIN scored_total s ON s.report_date = d.report_date GROUP BY d.report_date")
    return (with_clause(report_metrics(), start, end, scope, [_scored_cte()]) +
            f"\n{ranked}\nUNION ALL\n{total}")


def summary_total_period_sql(start, end, scope) -> str:
    """The summary with total row of one date, and its window with labels."""
    fmt = "'%d-%b-%Y (%I:%M %p)'"
    lo, hi = (f"d.report_date - INTERVAL {24 - WINDOW_HOUR} HOURS",
              f"d.report_date + INTERVAL {WINDOW_HOUR} HOURS")
    rows = summary_total_sql(start, end, scope)
    return (f"SELECT t.*, {lo} AS window_start, {hi} AS window_end, "
            f"strftime({lo}, {fmt}) AS period_start_label, strftime({hi}, {fmt}) "
            f"AS period_end_label FROM ({rows}) t CROSS JOIN (SELECT DATE '{as_date(start)}' "
            "AS report_date) d")


def diagnostics_sql(start, end, scope, keep_date: bool = False) -> str:
    aggs = []
    for m in MODULES:
        aggs.append(f"CAST(COALESCE(SUM(s.{_q(m)}), 0) AS BIGINT) AS {m}_total")
        if m in ("engage", "assess", "track"):
            aggs.append(f"CAST(COALESCE(SUM(s.{_q(m)} + s.college_id), 0) AS BIGINT) "
                        f"AS {m}_logged_total")
    aggs.append("CAST(COUNT(s.college_id) AS BIGINT) AS colleges_processed")
    aggs.append("CAST(COALESCE(SUM(s.total), 0) AS BIGINT) AS total_activities")
    diag = ("diag AS (SELECT d.report_date, " + ", ".join(aggs) +
            " FROM report_dates d LEFT JOIN scored_total s ON s.report_date = d.report_date "
            "GROUP BY d.report_date)")
    return (with_clause(report_metrics(), start, end, scope, [_scored_cte(), diag]) +
            f"\nSELECT {'' if keep_date else 'diag.* EXCLUDE (report_date), '}"
            f"{'diag.*, ' if keep_date else ''}format('{{:,}}', total_activities) "
            "AS total_activities_text FROM diag")


def period_sql(start, end, scope) -> str:
    diag = ("diag AS (SELECT d.report_date, CAST(COUNT(s.college_id) AS BIGINT) AS "
            "colleges_processed, CAST(COALESCE(SUM(s.total), 0) AS BIGINT) AS total_activities "
            "FROM report_dates d LEFT JOIN scored_total s ON s.report_date = d.report_date "
            "GROUP BY d.report_date)")
    fmt = "'%d-%b-%Y (%I:%M %p)'"
    return (with_clause(report_metrics(), start, end, scope, [_scored_cte(), diag]) +
            "\nSELECT report_date, colleges_processed, total_activities, "
            f"report_date - INTERVAL {24 - WINDOW_HOUR} HOURS AS window_start, "
            f"report_date + INTERVAL {WINDOW_HOUR} HOURS AS window_end, "
            f"strftime(report_date - INTERVAL {24 - WINDOW_HOUR} HOURS, {fmt}) "
            "AS period_start_label, "
            f"strftime(report_date + INTERVAL {WINDOW_HOUR} HOURS, {fmt}) AS period_end_label "
            "FROM diag")


def roster_scope_sql(scope) -> str:
    return (duckdb_ctes(["college"]) +
            f"\nSELECT CAST(id AS BIGINT) AS college_id, college_name FROM college "
            f"WHERE id IN {_scope_list(scope)}")


def eligible_students_sql(scope) -> str:
    return (duckdb_ctes(["college", "student_college_details"]) +
            "\nSELECT DISTINCT CAST(scd.college_id AS BIGINT) AS college_id, scd.student_id "
            f"FROM college c JOIN student_college_details scd ON scd.college_id = c.id "
            f"AND {_flags('scd')} WHERE c.id IN {_scope_list(scope)} "
            "AND scd.student_id IS NOT NULL")
