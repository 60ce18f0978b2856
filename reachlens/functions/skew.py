"""Hot join keys: found by a bounded frequency sketch, dealt over several tasks, the
others joined once.

A key is hot if it holds at least one in ``SHARE`` of the rows (so there are at most
``SHARE``) and ``LEAST_ROWS`` rows, which no task is too small for.  Its rows are
dealt over ``SALTS`` parts; a key that is not hot gives a task fewer than a
``SHARE``-th of the rows.  A missed or wrongly named key changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE, SALTS, LEAST_ROWS = 512, 256, 1000
# parts of a key where every key of a narrow side is repeated
NARROW_SALTS = 16
# values the sketch tracks: its error is far below a share
TRACKED = 8192


def hot_keys(rows: DataFrame, by: str, *columns: str) -> dict:
    """For each value of ``by`` (a few), the hot values of ``columns``: {by: {column: ids}}.

    One job: each task keeps a sketch of a bounded number of values, and at most
    ``SHARE`` ids a column and value of ``by`` reach the driver."""
    sketches = rows.groupBy(by).agg(F.count("*").alias("_n"), *(
        F.expr(f"approx_top_k(`{c}`, {SHARE}, {TRACKED})").alias(c) for c in columns))
    kept = [F.expr(f"""transform(filter(`{c}`, x -> x.item IS NOT NULL
                AND x.count >= greatest({LEAST_ROWS}, _n / {SHARE})), x -> CAST(x.item AS BIGINT))""").alias(c)
            for c in columns]
    return {r[by]: {c: sorted(r[c]) for c in columns} for r in sketches.select(by, *kept).collect()}


def is_broadcast(df: DataFrame) -> bool:
    """Whether Spark plans a join with ``df`` as a broadcast, by its estimated size: no
    key of the other side then meets in a task."""
    session = df.sparkSession._jsparkSession.sessionState()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= session.conf().autoBroadcastJoinThreshold()


def dealt_join(left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "inner",
               hot: Sequence[int] | None = None) -> DataFrame:
    """``left`` join ``right`` on ``key`` where one key may hold a third of ``left``: the
    left rows of the ``hot`` keys are dealt over parts by a hash of ``spread`` and
    only their right rows are repeated.  Without a list (for a narrow right side) all
    keys are."""
    if hot is not None and not hot:
        return left.join(right, key, how)
    salts = NARROW_SALTS if hot is None else SALTS
    part: Column = F.pmod(F.xxhash64(spread, F.lit("salt")), F.lit(salts)).cast("int")
    parts: Column = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        is_hot = F.col(key).isin([int(x) for x in hot])
        part = F.when(is_hot, part).otherwise(F.lit(0))
        parts = F.when(is_hot, parts).otherwise(F.array(F.lit(0)))
    return (left.withColumn("_part", part).join(right.withColumn("_part", F.explode(parts)), [key, "_part"], how)
            .drop("_part"))
