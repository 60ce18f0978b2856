"""Scope and eligibility: which colleges are reported, which enrolments count.

A scope is a list of college ids, which becomes a pushed IN filter, or a table with
a column ``college_id``, which becomes a semi join (a scope of any length; NULLs and
repeated ids do not count).  The caller's type decides, not a size."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlens.functions.skew import dealt_join
from reachlens.sources.catalog import Catalog
from reachlens.specs import ELIGIBLE_FLAGS

Scope = Iterable[int] | DataFrame


def scope_filter(column: str, scope: Iterable[int]) -> Column:
    return F.col(column).isin([int(x) for x in scope])


def scope_ids(scope: DataFrame, column: str) -> DataFrame:
    return scope.select(F.col("college_id").cast("bigint").alias(column)).distinct()


def scoped_colleges(catalog: Catalog, scope: Scope) -> DataFrame:
    """(college_id, college_name) for the scope's ids that exist in ``college``
    (at most one row per id: ``college.id`` is its key)."""
    colleges = catalog.table("college")
    found = (colleges.join(scope_ids(scope, "id"), "id", "left_semi") if isinstance(scope, DataFrame)
             else colleges.where(scope_filter("id", scope)))
    return found.select(F.col("id").alias("college_id"), "college_name")


def eligibility() -> Column:
    """Enrolment row counts only when all flags hold (a NULL flag fails)."""
    return reduce(lambda a, b: a & b, [F.col(c) == v for c, v in ELIGIBLE_FLAGS])


def eligible_enrolments(catalog: Catalog, scope: Scope) -> DataFrame:
    """Eligible enrolment rows of scoped colleges, each with its own batch id.

    Flags and batch come from the same row: the batch hop must not take the
    batch of an ineligible row of an eligible student.  With a scope table the
    enrolments of a hot college are dealt over several tasks."""
    rows = (catalog.table("student_college_details").where(eligibility())
            .select("student_id", "college_id", "regulation_batch_mapping_id"))
    if not isinstance(scope, DataFrame):
        return rows.where(scope_filter("college_id", scope))
    return dealt_join(rows, scope_ids(scope, "college_id"), "college_id", "student_id", "left_semi").select(*rows.columns)


def members(catalog: Catalog, scope: Scope) -> DataFrame:
    """Distinct (student_id, college_id) of eligible enrolments.  A student in
    two colleges is a member of both; two rows in one college collapse."""
    return (eligible_enrolments(catalog, scope).where(F.col("student_id").isNotNull())
            .select("student_id", "college_id").distinct())


def eligible_students(catalog: Catalog, scope: Scope) -> DataFrame:
    """Members of colleges that exist (semi join against the college list)."""
    colleges = scoped_colleges(catalog, scope).select("college_id")
    return members(catalog, scope).join(colleges, "college_id", "left_semi")
