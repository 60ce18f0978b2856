"""reachlens: activity-reach reporting on Spark.

Metrics are declared as small specs (bridge table, activity table, time column,
predicate).  For every organisation in scope Spark counts the distinct
(activity, eligible member) pairs inside a closed 08:00-to-08:00 window, for one
report date or for a whole range of dates in one pass, and shapes the counts
into a wide per-organisation table, a ranked module summary with a total row and
run diagnostics.
"""

from reachlens.specs import METRICS, MODULES, MetricSpec, metric, report_metrics
from reachlens.sources.catalog import Catalog

__all__ = ["Catalog", "METRICS", "MODULES", "MetricSpec", "metric", "report_metrics"]
