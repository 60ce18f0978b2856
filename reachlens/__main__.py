"""Run the report for one date or a date range and write its tables.

    python -m reachlens --tables /warehouse/lms --out /shared/reports
    python -m reachlens --tables /warehouse/lms --date 2024-01-15 --out /shared/reports
    python -m reachlens --tables /warehouse/lms --date 2024-01-01 --end 2024-01-31 --out ...
    python -m reachlens --testdata /root/testdata/sf0.01 --date 2024-01-15 --out ...

``--tables`` is a folder with one parquet table per report table; ``--jdbc-url``
reads the tables from a database instead; ``--testdata`` binds the driver's
generic test tables.  ``--out`` defaults to ``spark.checkpoint.dir``/reports.
Without ``--date`` the report date is today, taken once when the command starts.
The total row of each date is printed at the end (one row a date).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession
from reachlens.plans import ReachReport, presented
from reachlens.session import apply_defaults, shared_dir
from reachlens.sources.catalog import Catalog
from reachlens.specs import ACTIVE_COLLEGES


def main(argv: list[str] | None = None) -> dict[str, str]:
    p = argparse.ArgumentParser(prog="reachlens", description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with one parquet table per report table")
    src.add_argument("--jdbc-url", help="JDBC URL of the database holding the tables")
    src.add_argument("--testdata", help="driver test-data folder (bound views)")
    p.add_argument("--jdbc-properties", default="{}",
                   help='JSON: connection options, e.g. {"user": "...", "driver": "..."}')
    p.add_argument("--jdbc-partitioning", default="{}",
                   help='JSON: table -> [column, lower, upper, partitions]; tables that '
                        'grow with the students are else split on student_id')
    p.add_argument("--date", default=dt.date.today().isoformat(),
                   help="report date (YYYY-MM-DD; default: today)")
    p.add_argument("--end", help="last report date of a range (default: --date)")
    p.add_argument("--scope", help="comma-separated college ids (default: the active list)")
    p.add_argument("--scope-table", help="parquet table with the scope's ids in a column college_id "
                                         "(instead of --scope; of any length)")
    p.add_argument("--out", help="shared output folder")
    p.add_argument("--prune-bridges", action="store_true",
                   help="add an activity-id range filter to the bridge scans (one more job)")
    args = p.parse_args(argv)

    spark = apply_defaults(SparkSession.builder.appName("reachlens").getOrCreate())

    if args.tables:
        catalog = Catalog.from_parquet(spark, args.tables)
    elif args.jdbc_url:
        parts = {k: tuple(v) for k, v in json.loads(args.jdbc_partitioning).items()}
        catalog = Catalog.from_jdbc(spark, args.jdbc_url, json.loads(args.jdbc_properties),
                                    partitioning=parts)
    else:
        from reachlens.sources.bindings import bound_catalog
        catalog = bound_catalog(spark, args.testdata)

    if args.scope_table:
        scope = spark.read.parquet(args.scope_table)
    else:
        scope = [int(x) for x in args.scope.split(",")] if args.scope else ACTIVE_COLLEGES
    out = args.out or f"{shared_dir(spark)}/reports"
    report = ReachReport(catalog, args.date, args.end, scope=scope,
                         prune_bridges=args.prune_bridges)
    paths = report.run(out)
    totals = presented(report.stored_summary(paths).where("is_total").drop("is_total"))
    for row in totals.orderBy("report_date").toLocalIterator():
        print(json.dumps(row.asDict(), default=str))
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
