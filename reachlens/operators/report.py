"""Report shaping: wide per-college table, module summary, total row.

All frames carry ``report_date`` so a one-day report and a backfill share one
code path; ranks and serial numbers are windows partitioned by report date
(one partition holds the scoped colleges of one date, never all rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachlens.functions.timewin import date_range_column, period_label, window_end, window_start
from reachlens.specs import (MODULES, TOTAL_ROW_COLLEGE_ID, TOTAL_ROW_NAME, TOTAL_ROW_S_NO,
                             MetricSpec)

KEY = ("report_date", "college_id")


def college_dates(colleges: DataFrame, start, end) -> DataFrame:
    """Every scoped college on every report date (zero rows must show)."""
    return colleges.select(F.explode(date_range_column(start, end)).alias("report_date"),
                           "college_id", "college_name")


def wide_table(colleges: DataFrame, counts: DataFrame | None,
               specs: Sequence[MetricSpec], start, end) -> DataFrame:
    """One row per (report_date, scoped college), one column per metric.

    Long counts and one zero row per (date, college) are unioned and shaped
    by ONE hash aggregation (a pivot written as conditional sums over numeric
    buffers only, so it stays a HashAggregate with map-side partial
    aggregation).  Names come from an inner join to the scoped college list,
    which also drops listed ids that are not in ``college``."""
    names = [s.column for s in specs if s.constant is None]
    rows = college_dates(colleges, start, end).selectExpr(
        "report_date", "college_id", "CAST(NULL AS STRING) AS metric", "CAST(0 AS BIGINT) AS n")
    if counts is not None and names:
        rows = rows.unionByName(counts.selectExpr(
            "report_date", "college_id", "metric", "CAST(n AS BIGINT) AS n"))
    sums = [F.expr(f"coalesce(sum(CASE WHEN metric = '{c}' THEN n END), 0)").alias(c)
            for c in names]
    shaped = rows.groupBy(*KEY).agg(*sums) if sums else rows.select(*KEY).distinct()
    named = shaped.join(colleges, "college_id")
    cols = [f"CAST({s.constant} AS BIGINT) AS {s.column}" if s.constant is not None
            else f"CAST({s.column} AS BIGINT) AS {s.column}" for s in specs]
    return named.selectExpr(*KEY, "college_name", *cols)


def with_serial(wide: DataFrame) -> DataFrame:
    """S.No in college order, per report date."""
    order = Window.partitionBy("report_date").orderBy("college_id")
    rest = [c for c in wide.columns if c != "report_date"]
    return wide.select("report_date", F.row_number().over(order).cast("bigint").alias("s_no"),
                       *rest)


def module_score(specs: Sequence[MetricSpec], module: str) -> Column:
    cols = [F.col(s.column) for s in specs if s.module == module]
    if not cols:
        return F.lit(0).cast("bigint")
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def module_scores(wide: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """(report_date, college_id, college_name, teach .. remediate, total)."""
    scores = [module_score(specs, m).cast("bigint").alias(m) for m in MODULES]
    scored = wide.select(*KEY, "college_name", *scores)
    return scored.withColumn("total", sum((F.col(m) for m in MODULES[1:]), F.col(MODULES[0])))


def ranked(scored: DataFrame) -> DataFrame:
    """Rank by total, highest first; equal totals by college id."""
    order = Window.partitionBy("report_date").orderBy(F.desc("total"), F.asc("college_id"))
    return scored.select("report_date", F.row_number().over(order).cast("bigint").alias("s_no"),
                         "college_id", "college_name", *MODULES, "total")


def summary_with_total(scored: DataFrame, start, end) -> DataFrame:
    """Ranked rows plus one total row per report date from ONE window pass.

    A zero sentinel row is added per date (so the total row exists even when
    no college is in scope).  Within each date partition the sentinel ranks
    last and becomes the total row by taking the partition sums; every other
    row keeps its values and gets its rank.  One shuffle (by report date; a
    partition holds the scoped colleges of one date), no second aggregation."""
    values = (*MODULES, "total")
    sentinel = (scored.sparkSession.range(1)
                .select(F.explode(date_range_column(start, end)).alias("report_date"),
                        F.lit(None).cast("bigint").alias("college_id"),
                        F.lit(None).cast("string").alias("college_name"),
                        *[F.lit(0).cast("bigint").alias(m) for m in values],
                        F.lit(True).alias("is_total")))
    rows = (scored.select("report_date", "college_id", "college_name", *values)
            .withColumn("is_total", F.lit(False)).unionByName(sentinel))
    per_date = Window.partitionBy("report_date")
    ranking = per_date.orderBy(F.asc("is_total"), F.desc("total"), F.asc("college_id"))
    is_total = F.col("is_total")
    return rows.select(
        "report_date",
        F.when(is_total, F.lit(TOTAL_ROW_S_NO))
        .otherwise(F.row_number().over(ranking).cast("string")).alias("s_no"),
        F.when(is_total, F.lit(TOTAL_ROW_COLLEGE_ID))
        .otherwise(F.col("college_id").cast("string")).alias("college_id"),
        F.when(is_total, F.lit(TOTAL_ROW_NAME)).otherwise(F.col("college_name"))
        .alias("college_name"),
        *[F.when(is_total, F.sum(m).over(per_date)).otherwise(F.col(m)).cast("bigint").alias(m)
          for m in values],
        is_total.alias("is_total"))


def with_period(df: DataFrame) -> DataFrame:
    """Window bounds and display labels of each row's report date."""
    start = window_start(F.col("report_date"))
    end = window_end(F.col("report_date"))
    return df.select("*", start.alias("window_start"), end.alias("window_end"),
                     period_label(start).alias("period_start_label"),
                     period_label(end).alias("period_end_label"))
