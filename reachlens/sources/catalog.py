"""Table resolver: reference table name -> normalised DataFrame.

The operators never read files themselves; they ask a ``Catalog`` for a table by
the name the metric specs use.  A catalog can sit on a folder of parquet tables,
on metastore tables, on a JDBC database, or on DataFrames built elsewhere
(tests, derived views).
On load every known column is cast to the registry type (ids -> bigint,
flags -> int, zoned timestamps -> timestamp_ntz) and unknown columns are
dropped, so Catalyst prunes the scan to exactly the columns the specs use.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType

from reachlens.specs import table_schemas

Loader = Callable[[], DataFrame]


def normalise(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select ``columns`` and cast each to its declared type.

    Type "time" keeps DATE and TIMESTAMP_NTZ as they are and turns anything
    else (zoned timestamps, strings) into TIMESTAMP_NTZ; a string that is no
    valid time (e.g. a zero date) becomes NULL instead of failing under ANSI
    mode, and like a zero date it never falls in a report window.  Casts are
    only added where the type differs, so pushed filters stay on the raw
    column.  A window on a string column is not pushed into the scan: convert
    such a column once when the table is stored.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    current = {name: dtype.simpleString() for name, dtype in fields.items()}
    out = []
    for name, want in columns.items():
        if name not in current:
            raise KeyError(f"column {name!r} missing; have {sorted(current)}")
        if want == "time":
            if isinstance(fields[name], (DateType, TimestampNTZType)):
                out.append(F.col(name))
            elif isinstance(fields[name], StringType):
                out.append(F.expr(f"try_cast(`{name}` AS TIMESTAMP_NTZ)").alias(name))
            else:
                out.append(F.col(name).cast("timestamp_ntz").alias(name))
        elif current[name] == want:
            out.append(F.col(name))
        else:
            out.append(F.col(name).cast(want).alias(name))
    return df.select(*out)


class Catalog:
    """Name -> DataFrame, loaded lazily and once per catalog."""

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Loader],
                 schemas: Mapping[str, Mapping[str, str]] | None = None):
        self.spark = spark
        self._loaders = dict(loaders)
        self._schemas = dict(schemas) if schemas is not None else table_schemas()
        self._cache: dict[str, DataFrame] = {}

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._loaders:
                raise KeyError(f"table {name!r} is not bound in this catalog")
            df = self._loaders[name]()
            schema = self._schemas.get(name)
            self._cache[name] = normalise(df, schema) if schema else df
        return self._cache[name]

    # -- constructors ---------------------------------------------------------
    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Catalog:
        return cls(spark, {k: (lambda df=v: df) for k, v in frames.items()})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str,
                     names: list[str] | None = None, pattern: str = "{root}/{name}") -> Catalog:
        """Parquet tables under ``root`` (one folder or file per table; a
        date-partitioned folder is pruned by Spark from the window filter)."""
        names = names if names is not None else sorted(table_schemas())
        return cls(spark, {n: (lambda n=n: spark.read.parquet(pattern.format(root=root, name=n)))
                           for n in names})

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str | None = None,
                    names: list[str] | None = None) -> Catalog:
        """Tables (or views) of the session catalog, e.g. a metastore database
        whose tables carry their own partitioning and statistics."""
        names = names if names is not None else sorted(table_schemas())
        prefix = f"{database}." if database else ""
        return cls(spark, {n: (lambda n=n: spark.table(f"{prefix}{n}")) for n in names})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, properties: Mapping[str, str],
                  tables: Mapping[str, str] | None = None,
                  partitioning: Mapping[str, tuple[str, int, int, int]] | None = None
                  ) -> Catalog:
        """``tables`` maps report table name -> database table (default: same
        name); ``partitioning`` is keyed by report table name.  Tables with a
        student_id (they grow with the students) are split on it, into slices
        of about equally many rows that the database counts, where
        ``partitioning`` does not say otherwise; never read by one task.
        Column names are matched case-insensitively (databases may upper-case
        them)."""
        from reachlens.sources.jdbc import read_table
        tables = dict(tables) if tables is not None else {n: n for n in table_schemas()}
        partitioning = partitioning or {}
        schemas = table_schemas()

        def load(name: str) -> DataFrame:
            split_on = "student_id" if "student_id" in schemas.get(name, {}) else None
            df = read_table(spark, url, tables[name], properties, partitioning.get(name),
                            split_on=split_on)
            return df.toDF(*[c.lower() for c in df.columns])

        return cls(spark, {n: (lambda n=n: load(n)) for n in tables})
