"""Student-keyed metrics: distinct (activity, member) pairs per college.

Plan per report (all metrics at once):

1. per source group: window-filter the time side (pushed into the scan), map
   each surviving row to its report date(s), join bridge to activity ids;
   metrics that read the same bridge and activity table share one scan and get
   their label from the activity flags.  Hot activities are found first, by a
   bounded frequency sketch over the bridges (``hot_links``, one small job a
   report for the joins that Spark does not broadcast): their links are dealt over many tasks by a hash of the student and only
   their rows are repeated, so one activity linked to a third of all students is
   spread in any session, without skew settings, and every other activity is
   joined once, by its id alone;
2. union the groups to one fact (metric, report_date, student_id, event_id) and
   keep the links of eligible students (a semi join on the student; hot students
   come from the same sketch and are dealt by a hash of the activity), so what
   follows grows with the scope;
3. count distinct activities per (metric, report_date, student): a map-side
   dedupe, then the pairs meet by student (without hot students where the semi
   join left them) or by all four keys;
4. join the per-student counts to the members (one row per student and
   college on both sides) and sum per college.

Because (student, activity) pairs are distinct before the join and (student,
college) pairs are distinct in ``members``, the join output is distinct on
(college, activity, student), so the sum equals the distinct-pair count.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlens.functions.skew import dealt_join, hot_keys, is_broadcast
from reachlens.functions.timewin import in_date_range, in_window, report_dates
from reachlens.sources.catalog import Catalog
from reachlens.specs import MetricSpec

PAIR_COLUMNS = ("metric", "report_date", "student_id", "event_id")


def with_metric_labels(df: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Add the metric name(s) of each row of a shared source: one literal when
    the group has one unfiltered spec, else one row per spec whose activity
    filter holds (a row can feed several metrics)."""
    if len(specs) == 1 and specs[0].event_filter is None:
        return df.withColumn("metric", F.lit(specs[0].column))
    tagged = ", ".join(f"CASE WHEN {s.event_filter or 'true'} THEN '{s.column}' END"
                       for s in specs)
    labels = F.expr(f"filter(array({tagged}), x -> x IS NOT NULL)")
    return df.withColumn("metric", F.explode(labels))


def _with_report_date(df: DataFrame, time_col: str, ttype, start, end) -> DataFrame:
    """One row per report date in [start, end] whose window holds the time."""
    return (df.withColumn("report_date", F.explode(report_dates(time_col, ttype)))
            .where(in_date_range("report_date", start, end)))


def _any_filter(specs: Sequence[MetricSpec]) -> Column | None:
    if any(s.event_filter is None for s in specs):
        return None
    return reduce(lambda a, b: a | b, [F.expr(s.event_filter) for s in specs])


def filtered_events(catalog: Catalog, specs: Sequence[MetricSpec]) -> DataFrame:
    event = catalog.table(specs[0].event)
    wanted = _any_filter(specs)
    return event.where(wanted) if wanted is not None else event


def activity_id_bounds(catalog: Catalog, groups: Sequence[Sequence[MetricSpec]],
                       start, end) -> dict[tuple, tuple[int, int] | None]:
    """(min, max) id of the windowed activities of every activity-timed
    source, from ONE small job (one row per source reaches the driver).

    A bridge row whose activity id lies outside that range cannot match, so
    ``fk BETWEEN min AND max`` is an exact filter that parquet can use to skip
    row groups and files: activity ids grow with time, so the bridge rows of
    one day's activities sit in a narrow id range.  Sources with no activity
    in the window map to None (their branch is empty)."""
    timed = [g for g in groups if g[0].time_side == "event"]
    if not timed:
        return {}
    parts = []
    for i, g in enumerate(timed):
        event = filtered_events(catalog, g)
        ttype = event.schema[g[0].time_col].dataType
        parts.append(event.where(in_window(g[0].time_col, ttype, start, end))
                     .select(F.lit(i).alias("source"), F.col("id")))
    rows = (reduce(lambda a, b: a.unionByName(b), parts).groupBy("source")
            .agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect())
    found = {r.source: (r.lo, r.hi) for r in rows if r.lo is not None}
    return {g[0].source_key: found.get(i) for i, g in enumerate(timed)}


def source_links(catalog: Catalog, specs: Sequence[MetricSpec], start, end,
                 id_bounds: dict[tuple, tuple[int, int] | None] | None = None) -> DataFrame:
    """The bridge rows (student_id, event_id, and the report date where the link
    has the time) that specs sharing one source join to their activities."""
    head = specs[0]
    bridge = catalog.table(head.bridge)
    columns = ["student_id", F.col(head.bridge_fk).alias("event_id")]
    if head.time_side == "event":
        if id_bounds is not None and head.source_key in id_bounds:
            low, high = id_bounds[head.source_key] or (1, 0)
            bridge = bridge.where(F.col(head.bridge_fk).between(low, high))
        return bridge.select(*columns)
    ttype = bridge.schema[head.time_col].dataType
    windowed = bridge.where(in_window(head.time_col, ttype, start, end))
    return _with_report_date(windowed, head.time_col, ttype, start, end).select(*columns, "report_date")


def source_activities(catalog: Catalog, specs: Sequence[MetricSpec], start, end,
                      id_bounds: dict[tuple, tuple[int, int] | None] | None = None) -> DataFrame:
    """The activities (event_id, and what the links lack: report date, metric) that specs
    sharing one source join to their links."""
    head = specs[0]
    event = filtered_events(catalog, specs)
    if head.time_side != "event":
        if len(specs) == 1:
            return event.select(F.col("id").alias("event_id"))
        return with_metric_labels(event, specs).select(F.col("id").alias("event_id"), "metric")
    ttype = event.schema[head.time_col].dataType
    activities = event.where(in_window(head.time_col, ttype, start, end))
    activities = _with_report_date(activities, head.time_col, ttype, start, end)
    activities = with_metric_labels(activities, specs).select(
        F.col("id").alias("event_id"), "report_date", "metric")
    if id_bounds is not None and head.source_key in id_bounds:
        # on both sides: an activity added since the bounds were read is left out whole
        low, high = id_bounds[head.source_key] or (1, 0)
        activities = activities.where(F.col("event_id").between(low, high))
    return activities


def source_pairs(catalog: Catalog, specs: Sequence[MetricSpec], start, end,
                 id_bounds: dict[tuple, tuple[int, int] | None] | None = None,
                 hot: Sequence[int] = ()) -> DataFrame:
    """(metric, report_date, student_id, event_id) for specs sharing one source.

    ``id_bounds`` (from ``activity_id_bounds``) adds the exact activity-id range
    filter to the bridge scan; ``hot`` lists the source's hot activities."""
    links = source_links(catalog, specs, start, end, id_bounds)
    activities = source_activities(catalog, specs, start, end, id_bounds)
    if "metric" in activities.columns:
        pairs = dealt_join(links, activities, "event_id", "student_id", "inner", hot)
    else:
        pairs = (dealt_join(links, activities, "event_id", "student_id", "left_semi", hot)
                 .withColumn("metric", F.lit(specs[0].column)))
    return pairs.select(*PAIR_COLUMNS)


def grouped_sources(specs: Iterable[MetricSpec]) -> list[list[MetricSpec]]:
    """Student-keyed specs grouped by shared source, in first-seen order."""
    groups: dict[tuple, list[MetricSpec]] = {}
    for s in specs:
        if s.student_keyed:
            groups.setdefault(s.source_key, []).append(s)
    return list(groups.values())


def hot_links(catalog: Catalog, groups: Sequence[Sequence[MetricSpec]], start, end,
              students: DataFrame | None = None) -> dict[tuple, dict[str, list[int]]]:
    """The hot activities (``event_id``) and students (``student_id``) of each source, from
    one small job over the links of the sources that need it: where Spark
    broadcasts the activities and the ``students``, no key's links meet in a task."""
    few = students is None or is_broadcast(students)
    sought = [i for i, g in enumerate(groups) if not (few and is_broadcast(source_activities(catalog, g, start, end)))]
    links = [source_links(catalog, groups[i], start, end).select(F.lit(i).alias("source"), "event_id", "student_id")
             for i in sought]
    found = hot_keys(reduce(lambda a, b: a.unionByName(b), links), "source", "event_id", "student_id") if links else {}
    none: dict[str, list[int]] = {"event_id": [], "student_id": []}
    return {g[0].source_key: found.get(i, none) for i, g in enumerate(groups)}


def activity_pairs(catalog: Catalog, specs: Iterable[MetricSpec], start, end,
                   prune_bridges: bool = False, hot: dict[tuple, dict[str, list[int]]] | None = None
                   ) -> DataFrame | None:
    """The union of all student-keyed pair sources, or None if there are none.
    ``prune_bridges`` adds the activity-id range filter to every bridge scan
    (one extra small job); ``hot`` is what ``hot_links`` has found, if it is known."""
    groups = grouped_sources(specs)
    if not groups:
        return None
    bounds = activity_id_bounds(catalog, groups, start, end) if prune_bridges else None
    hot = hot if hot is not None else hot_links(catalog, groups, start, end)
    return reduce(lambda a, b: a.unionByName(b),
                  [source_pairs(catalog, g, start, end, bounds, hot[g[0].source_key]["event_id"]) for g in groups])


def of_students(pairs: DataFrame, students: DataFrame, hot: Sequence[int] = ()) -> DataFrame:
    """The pairs whose student is among ``students`` (distinct student_id); those of
    the ``hot`` students are dealt over several tasks."""
    return dealt_join(pairs, students, "student_id", "event_id", "left_semi", hot).select(*PAIR_COLUMNS)


def per_member_counts(pairs: DataFrame) -> DataFrame:
    """(metric, report_date, student_id, n) - distinct activities per member."""
    return (pairs.groupBy("metric", "report_date", "student_id")
            .agg(F.count_distinct("event_id").alias("n")))


def college_counts(per_member: DataFrame, members: DataFrame) -> DataFrame:
    """Member rows of each college: (report_date, college_id, metric, n)."""
    return (per_member.join(members, "student_id")
            .select("report_date", "college_id", "metric", "n"))
