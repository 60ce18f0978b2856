"""Batch-hop metric: activities that reach members through their batch.

An assignment belongs to a subject mapping, a mapping to a batch id, and an
eligible enrolment row carries a batch id.  The metric is the number of
distinct (assignment, student) pairs per college.  Listing those pairs costs
students x assignments per batch; instead the count is built from two much
smaller sides:

* per (college, student) the *signature*: the sorted set of batch ids of the
  student's eligible rows in that college.  Students with the same signature
  reach exactly the same assignments, so only
  ``n_students(college, signature)`` is kept.
* per (report_date, signature) the number of distinct assignments reachable from
  any batch of the signature, in two parts.  An assignment that reaches one batch
  only (its mapping has one) is counted once per batch and the counts are added.
  Assignments that reach several batches are kept as bitmaps of their ids, one for
  each (report_date, batch, bucket of 1,024 ids); a signature joins its batches'
  bitmaps, and the bits of their union are counted.  A bitmap is sixteen 64-bit
  words built and united by ``bit_or``, so the aggregations stay hash-based with
  map-side partials (the functions on 4 KiB bitmaps would sort).

count(college, date) = sum over signatures of n_students * n_assignments.  This
is exact for any data: a student with several batches counts each assignment
once, and so does an assignment mapped to several batches.  No join lists
signatures with assignments: they meet counts and bitmaps, one row for each
batch of a signature, date and bucket.  A batch in a third of all signatures is
dealt over several tasks (``functions.skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.functions.skew import dealt_join
from reachlens.functions.timewin import in_date_range, in_window, report_dates
from reachlens.operators.roster import Scope, eligible_enrolments
from reachlens.sources.catalog import Catalog
from reachlens.specs import MetricSpec


#: 64-bit words of a bitmap: 1,024 ids
WORDS = 16


def batch_assignments(catalog: Catalog, spec: MetricSpec, start, end) -> DataFrame:
    """(report_date, batch, assignment_id) for assignments in the window."""
    assignments = catalog.table(spec.event)
    ttype = assignments.schema[spec.time_col].dataType
    windowed = (assignments.where(in_window(spec.time_col, ttype, start, end))
                .withColumn("report_date", F.explode(report_dates(spec.time_col, ttype)))
                .where(in_date_range("report_date", start, end))
                .select("report_date", F.col("id").alias("assignment_id"),
                        F.col("college_subject_mapping_id").alias("mapping_id")))
    mappings = catalog.table("college_subject_mapping").select(
        F.col("id").alias("mapping_id"), F.col("regulation_batch_mapping_id").alias("batch"))
    return windowed.join(mappings, "mapping_id").select("report_date", "batch", "assignment_id")


def signature_sizes(catalog: Catalog, scope: Scope) -> DataFrame:
    """(college_id, signature, n_students).  The per-(college, student) set is
    built with map-side partial aggregation and holds the few batches of one
    student; rows without a batch reach nothing and are dropped."""
    rows = eligible_enrolments(catalog, scope).where(
        F.col("regulation_batch_mapping_id").isNotNull() & F.col("student_id").isNotNull())
    signatures = (rows.groupBy("college_id", "student_id")
                  .agg(F.array_sort(F.collect_set("regulation_batch_mapping_id"))
                       .alias("signature")))
    return signatures.groupBy("college_id", "signature").agg(F.count("*").alias("n_students"))


def reachable(assigned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (report_date, batch, assignment_id): the number of assignments that reach
    only that batch (report_date, batch, n_assignments), and the bitmaps of the
    others (report_date, batch, bucket and the words w0, w1, ...)."""
    reach = (assigned.groupBy("report_date", "assignment_id")
             .agg(F.collect_set("batch").alias("batches")))
    alone = (reach.where(F.size("batches") == 1)
             .groupBy("report_date", F.col("batches")[0].alias("batch"))
             .agg(F.count("*").alias("n_assignments")))
    bit = F.expr("shiftleft(1L, CAST(assignment_id & 63 AS INT))")
    word = F.expr(f"(assignment_id >> 6) & {WORDS - 1}")
    shared = (reach.where(F.size("batches") > 1)
              .select("report_date", "assignment_id", F.explode("batches").alias("batch"))
              .groupBy("report_date", "batch", F.expr("assignment_id >> 10").alias("bucket"))
              .agg(*(F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"w{k}")
                     for k in range(WORDS))))
    return alone, shared


def assignments_of(signatures: DataFrame, assigned: DataFrame) -> DataFrame:
    """(report_date, signature, n_assignments): distinct assignments that reach any
    batch of each of the distinct ``signatures``."""
    listed = signatures.select("signature", F.explode("signature").alias("batch"))
    alone, shared = reachable(assigned)
    one = dealt_join(listed, alone, "batch", "signature").select("report_date", "signature", "n_assignments")
    several = (dealt_join(listed, shared, "batch", "signature").groupBy("report_date", "signature", "bucket")
               .agg(*(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)))
               .select("report_date", "signature",
                       sum((F.bit_count(f"w{k}") for k in range(1, WORDS)), F.bit_count("w0"))
                       .cast("bigint").alias("n_assignments")))
    return (one.unionByName(several).groupBy("report_date", "signature")
            .agg(F.sum("n_assignments").alias("n_assignments")))


def batch_hop_counts(catalog: Catalog, spec: MetricSpec, scope: Scope,
                     start, end) -> DataFrame:
    """(report_date, college_id, metric, n) for one batch-hop metric."""
    sizes = signature_sizes(catalog, scope)
    reached = assignments_of(sizes.select("signature").distinct(),
                             batch_assignments(catalog, spec, start, end))
    return (sizes.join(reached, "signature").groupBy("report_date", "college_id")
            .agg(F.sum(F.col("n_students") * F.col("n_assignments")).alias("n"))
            .select("report_date", "college_id", F.lit(spec.column).alias("metric"), "n"))
