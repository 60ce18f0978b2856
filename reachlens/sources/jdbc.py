"""JDBC source: a database table read in parallel slices.

Without a partition column a JDBC read is one task holding the whole table.
``partitioning`` gives (column, lower, upper, num_partitions) and Spark issues
one range query per slice.  ``split_on`` names only an integer column: the
database counts its values by range (``count_slices``), and the slices hold
about equally many rows however the values are spread; NULLs are a slice of
their own.  Window filters and column lists are pushed into each slice's SQL by
Spark; joins and aggregates run in Spark.

For MySQL, add ``zeroDateTimeBehavior=CONVERT_TO_NULL`` to the URL: zero dates
then arrive as NULL, which (like the original's datetime truthiness test)
never falls in a report window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: ranges that one counting query distinguishes
CELLS = 1024


def count_slices(ask: Callable[[str], list], table: str, column: str, slices: int) -> list[str]:
    """Predicates that cut ``table`` by ``column`` into slices of about equally many
    rows, every row in exactly one.

    ``ask`` runs a query in the database.  A range with more rows than a slice
    should have is counted again in ``CELLS`` narrower ranges, until its ranges are small
    or a single value; at most ``slices`` ranges are too large at a time, and
    a round narrows them by ``CELLS``, so a handful of queries on 64-bit values
    is enough and only counts reach the driver.  A value that alone exceeds a
    slice keeps one of its own.  Rows that come later fall into the outer, open slices."""
    known, low, high = ask(f"SELECT count({column}) AS known, min({column}) AS low, max({column}) AS high "
                           f"FROM {table}")[0]
    none = f"{column} IS NULL"
    if not known:
        return [none]
    most = -(-int(known) // slices)
    cells, large = [], [(int(low), int(high) + 1, int(known))]
    while large:
        start, end, rows = large.pop()
        if rows <= most or end - start == 1:
            cells.append((start, end, rows))
            continue
        width = -(-(end - start) // CELLS)
        offset = f"({column} - ({start}))"
        cell = f"({offset} - MOD({offset}, {width})) / {width}"
        for number, n in ask(f"SELECT {cell} AS cell, count(*) AS n FROM {table} "
                             f"WHERE {column} >= {start} AND {column} < {end} GROUP BY {cell}"):
            first = start + int(number) * width
            large.append((first, min(end, first + width), int(n)))
    starts, held = [], most
    for start, _, rows in sorted(cells):
        if held + rows > most:
            starts.append(start)
            held = 0
        held += rows
    bounds = [None, *starts[1:], None]
    ranges = [[f"{column} >= {a}"] * (a is not None) + [f"{column} < {b}"] * (b is not None)
              for a, b in zip(bounds, bounds[1:])]
    return [" AND ".join(r) if r else f"{column} IS NOT NULL" for r in ranges] + [none]


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
               partitioning: tuple[str, int, int, int] | None = None,
               fetch_size: int = 10_000, split_on: str | None = None,
               slices: int = 32) -> DataFrame:
    """``table`` (or a subquery with an alias).  With ``split_on`` the counting queries
    run when the table is first read."""
    reader = (spark.read.format("jdbc").option("url", url)
              .option("fetchsize", str(fetch_size))
              # datetimes without zone stay wall-clock values
              .option("preferTimestampNTZ", "true"))
    for key, value in properties.items():
        reader = reader.option(key, value)
    if partitioning is not None:
        column, lower, upper, parts = partitioning
        return (reader.option("dbtable", table).option("partitionColumn", column)
                .option("lowerBound", str(lower)).option("upperBound", str(upper))
                .option("numPartitions", str(parts)).load())
    if split_on is None:
        return reader.option("dbtable", table).load()

    def ask(query: str) -> list:
        return read_table(spark, url, f"({query}) q", properties, fetch_size=fetch_size).collect()

    # as the database spells the column, quoted its way
    name = next(c for c in read_table(spark, url, table, properties).columns if c.lower() == split_on.lower())
    quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(name)
    return reader.jdbc(url, table, predicates=count_slices(ask, table, quoted, slices), properties=dict(properties))
