"""Column-level helpers: window bounds and predicates, report-date fan-out, labels."""

from reachlens.functions.timewin import (date_range_column, in_date_range, in_window,
                                         period_label, report_dates, window_bounds,
                                         window_end, window_start)

__all__ = ["date_range_column", "in_date_range", "in_window", "period_label", "report_dates",
           "window_bounds", "window_end", "window_start"]
