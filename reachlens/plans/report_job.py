"""The report as one Spark job: specs -> counts -> wide table -> summary.

``ReachReport(catalog, start, end)`` covers report dates start..end (one date
when ``end`` is omitted).  Every metric of the report is computed in one plan:
one union of pair sources, one distinct count, one member join, one shaping
aggregation (pivot + zero rows).
``run`` writes the wide table first and derives summary, total row and
diagnostics from the written table, so the counting plan runs once and the
lineage of the small report tables starts at the shared folder.  Otherwise, building
a plan starts one job at most: the sketch that finds hot activities and students
(once a report and source, where Spark would not broadcast the other side; ``prune_bridges``, off by default, adds another, and a JDBC
catalog counts the slices of a table when it is first read).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.functions.timewin import as_date, in_date_range
from reachlens.operators import activity, batch_hop, report, roster
from reachlens.sources import sinks
from reachlens.sources.catalog import Catalog
from reachlens.specs import ACTIVE_COLLEGES, METRICS, MODULES, MetricSpec, metric


class ReachReport:
    def __init__(self, catalog: Catalog, start, end=None,
                 scope: roster.Scope = ACTIVE_COLLEGES,
                 specs: Sequence[MetricSpec] = METRICS, prune_bridges: bool = False):
        self.catalog = catalog
        self.spark = catalog.spark
        self.start = as_date(start)
        self.end = as_date(end) if end is not None else self.start
        if self.end < self.start:
            raise ValueError(f"empty date range {self.start}..{self.end}")
        # a list of college ids, or a table with a column college_id
        self.scope = scope if isinstance(scope, DataFrame) else tuple(int(x) for x in scope)
        self.specs = tuple(specs)
        # the wide report's metrics, in column order
        self.report_specs = tuple(s for s in self.specs if s.in_report)
        # exact activity-id range filter on bridge scans (one small extra job)
        self.prune_bridges = prune_bridges
        self._hot: dict[tuple, dict[str, list[int]]] = {}

    # -- building blocks -----------------------------------------------------
    def colleges(self) -> DataFrame:
        return roster.scoped_colleges(self.catalog, self.scope)

    def members(self) -> DataFrame:
        return roster.members(self.catalog, self.scope)

    def students(self) -> DataFrame:
        return self.members().select("student_id").distinct()

    def hot_links(self, specs: Sequence[MetricSpec]) -> dict[tuple, dict[str, list[int]]]:
        """Hot activities and students of the specs' sources (one job for those not
        yet known to this report)."""
        groups = activity.grouped_sources(specs)
        new = [g for g in groups if g[0].source_key not in self._hot]
        if new:
            self._hot |= activity.hot_links(self.catalog, new, self.start, self.end, self.students())
        return {g[0].source_key: self._hot[g[0].source_key] for g in groups}

    def member_counts(self, specs: Sequence[MetricSpec] | None = None) -> DataFrame | None:
        """(metric, report_date, student_id, n): distinct activities per
        eligible member and day for the student-keyed ``specs``."""
        keyed = [s for s in (specs if specs is not None else self.report_specs)
                 if s.student_keyed]
        if not keyed:
            return None
        hot = self.hot_links(keyed)
        pairs = activity.activity_pairs(self.catalog, keyed, self.start, self.end,
                                        self.prune_bridges, hot)
        # a student with a share of all links has that share in one source at least
        often = sorted({i for ids in hot.values() for i in ids["student_id"]})
        return activity.per_member_counts(activity.of_students(pairs, self.students(), often))

    def counts(self, specs: Sequence[MetricSpec]) -> DataFrame | None:
        """Long rows (report_date, college_id, metric, n) of ``specs`` whose sum
        per (report_date, college_id, metric) is the metric (one row per member
        for student-keyed metrics, one per college for the batch hop)."""
        parts = []
        per_member = self.member_counts(specs)
        if per_member is not None:
            parts.append(activity.college_counts(per_member, self.members()))
        for s in specs:
            if s.hop == "batch":
                parts.append(batch_hop.batch_hop_counts(self.catalog, s, self.scope,
                                                        self.start, self.end))
        if not parts:
            return None
        return reduce(lambda a, b: a.unionByName(b), parts)

    def wide(self, specs: Sequence[MetricSpec] | None = None) -> DataFrame:
        """(report_date, college_id, college_name, one column per spec)."""
        specs = tuple(specs) if specs is not None else self.report_specs
        return report.wide_table(self.colleges(), self.counts(specs), specs,
                                 self.start, self.end)

    # -- report outputs ---------------------------------------------------------
    def metric_frame(self, column: str) -> DataFrame:
        """One metric: (report_date, college_id, college_name, <column>)."""
        own = [s for s in self.specs if s.column == column]
        return self.wide(own[:1] or [metric(column)])

    def module_frame(self, module: str) -> DataFrame:
        return self.wide([s for s in self.report_specs if s.module == module])

    def combined(self) -> DataFrame:
        """Wide report with serial numbers (S.No, ids, 16 metrics)."""
        return report.with_serial(self.wide())

    def scored(self, wide: DataFrame | None = None) -> DataFrame:
        wide = wide if wide is not None else self.wide()
        return report.module_scores(wide, self.report_specs)

    def summary(self, wide: DataFrame | None = None) -> DataFrame:
        """Module scores and total, ranked by total."""
        return report.ranked(self.scored(wide))

    def summary_with_total(self, wide: DataFrame | None = None) -> DataFrame:
        return report.summary_with_total(self.scored(wide), self.start, self.end)

    def diagnostics(self, wide: DataFrame | None = None) -> DataFrame:
        """Per report date: module totals, the original's logged totals (which
        also add up college ids for the three merged module frames), number of
        colleges, total activities and its display text."""
        wide = wide if wide is not None else self.wide()
        specs = self.report_specs
        aggs = []
        for m in MODULES:
            score = report.module_score(specs, m)
            aggs.append(F.coalesce(F.sum(score), F.lit(0)).cast("bigint").alias(f"{m}_total"))
            if m in ("engage", "assess", "track"):
                aggs.append(F.coalesce(F.sum(score + F.col("college_id")), F.lit(0))
                            .cast("bigint").alias(f"{m}_logged_total"))
        total = sum((report.module_score(specs, m) for m in MODULES[1:]),
                    report.module_score(specs, MODULES[0]))
        aggs.append(F.count("*").cast("bigint").alias("colleges_processed"))
        aggs.append(F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("total_activities"))
        frame = self.spark.range(1).select(
            F.explode(report.date_range_column(self.start, self.end)).alias("report_date"))
        diag = frame.join(wide.groupBy("report_date").agg(*aggs), "report_date", "left")
        filled = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                  for c in diag.columns if c != "report_date"]
        diag = diag.select("report_date", *filled)
        return diag.withColumn("total_activities_text",
                               F.format_number(F.col("total_activities"), 0))

    def period(self, wide: DataFrame | None = None) -> DataFrame:
        """Report window and its display labels, with the activity total."""
        diag = self.diagnostics(wide).select("report_date", "colleges_processed",
                                             "total_activities")
        return report.with_period(diag)

    # -- production run ------------------------------------------------------------
    def run(self, out_dir: str) -> dict[str, str]:
        """Write the wide table, then summary + total and diagnostics from it.

        ``out_dir`` must be a shared folder (e.g. under spark.checkpoint.dir).
        Each table is date-partitioned; a run replaces the partition of every
        date of its range.  A date without a college row gets one row without
        college in the wide table, which keeps its partition and which
        ``stored_wide`` leaves out; the other tables have a row for each date
        anyway (total row, diagnostics).  Both carry the window's bounds and
        labels."""
        out = out_dir.rstrip("/")
        paths = {"individual_data": f"{out}/individual_data",
                 "usage_data": f"{out}/usage_data",
                 "diagnostics": f"{out}/diagnostics"}
        wide = self.combined()
        dates = self.spark.range(1).select(
            F.explode(report.date_range_column(self.start, self.end)).alias("report_date"))
        sinks.write_table(dates.join(wide, "report_date", "left"), paths["individual_data"])
        stored = (self.stored(paths["individual_data"], wide)
                  .where("college_id IS NOT NULL").drop("s_no"))
        sinks.write_table(report.with_period(self.summary_with_total(stored)), paths["usage_data"])
        sinks.write_table(report.with_period(self.diagnostics(stored)), paths["diagnostics"])
        return paths

    def stored(self, path: str, like: DataFrame) -> DataFrame:
        """The rows of a stored table in this report's date range, read with the
        schema of the frame it was written from."""
        return sinks.read_table(self.spark, path, like.schema).where(
            in_date_range("report_date", self.start, self.end)).select(*like.columns)

    def stored_wide(self, paths: dict[str, str]) -> DataFrame:
        """The stored ``combined`` table."""
        return self.stored(paths["individual_data"], self.combined()).where("college_id IS NOT NULL")

    def stored_summary(self, paths: dict[str, str]) -> DataFrame:
        """The stored summary with its total rows, bounds and labels."""
        return self.stored(paths["usage_data"], report.with_period(self.summary_with_total()))

    def stored_period(self, paths: dict[str, str]) -> DataFrame:
        """What ``period`` shows, from the stored diagnostics."""
        return self.stored(paths["diagnostics"], report.with_period(self.diagnostics())).select(
            *self.period().columns)


def presented(df: DataFrame) -> DataFrame:
    """A report table under the original's headings."""
    return df.withColumnRenamed("s_no", "S.No")


def drop_date(df: DataFrame) -> DataFrame:
    """Single-day presentation: the report date is implied by the run."""
    return df.drop("report_date")
