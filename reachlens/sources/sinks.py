"""Sinks: date-partitioned parquet tables with dynamic partition overwrite.

A write replaces exactly the date partitions that its frame has rows of, so a
caller that must replace a date also when it has nothing to report gives that
date a row (``ReachReport.run`` does).  A re-run after a lost executor or a
failed job writes the same partitions again: writes are idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("report_date",)) -> str:
    """Overwrite the partitions present in ``df`` under ``path``.

    Report tables hold a few rows per (date, college), so the rows of a date go
    to one task and one file; their number is bounded by the scope."""
    (df.repartition(*partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    return path


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table; the schema is the writer's, never inferred from files."""
    return spark.read.schema(schema).parquet(path)
