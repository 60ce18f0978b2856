"""Whole-report plans (one date or a date range) and their SQL cross-checks."""

from reachlens.plans.report_job import ReachReport, drop_date, presented

__all__ = ["ReachReport", "drop_date", "presented"]
