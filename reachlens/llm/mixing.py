"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of all characters over its actual
share.  Each document draws its number of copies from the Poisson distribution
of that mean by inverting it at a number made from a hash of seed and doc_id,
so a rerun gives the same copies.  Rates above ``PART`` are drawn as sums of
several such numbers.  Copies are exploded and ordered by a hash of doc_id and
copy: a global shuffle in which every range takes rows of all sources.  The hash is
uniform, so its leading digits name the range, and no sample is drawn first.

Defined results: a null source is a source of its own; null and empty texts add
no characters to their source; a source without characters, and every source
if no weight is positive, has the rate 1; rows repeating a doc_id draw the same number,
rows without one a number of their own (by row number, so the table must give its
rows in the same order to every attempt, as a stored one does); sources missing from
``weights`` get none; an empty table gives an empty result; columns of the input
named ``copy`` or ``order_key`` are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlens.llm.common import partitions, salted_join, written

SEED = "mix-1"
PART = 16.0
TERMS = 80              # P(X >= 80) is below 1e-26 for a mean of 16
BROADCAST_SOURCES = 20_000
NULL = "\u0002"


def unit(*parts: Column | str) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
          scale: float = 1.0) -> DataFrame:
    """(_source, rate): mean copies of a document of each source.  Without
    ``weights`` a source's target is the square root of its characters, which
    lifts small sources; ``scale`` is the wanted size of the output."""
    chars = docs.groupBy(F.coalesce("source", F.lit(NULL)).alias("_source")).agg(
        F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    if weights is None:
        target = F.sqrt("chars")
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(NULL if k is None else k), F.lit(float(v)))]
        target = F.coalesce(F.create_map(*pairs)[F.col("_source")], F.lit(0.0)) if pairs else F.lit(0.0)
    chars = written(chars.withColumn("target", F.when(F.col("chars") > 0, target)), "sources")
    total = chars.agg(F.sum("chars").alias("c"), F.sum("target").alias("t")).head()
    if not total.c or not total.t:
        return chars.select("_source", F.lit(1.0).alias("rate"))
    rate = F.col("target") / F.lit(total.t) * F.lit(total.c * scale) / F.col("chars")
    return chars.select("_source", F.coalesce(rate, F.lit(1.0)).alias("rate"))


def with_distribution(sources: DataFrame) -> DataFrame:
    """Adds ``parts`` and ``steps``, the cumulative probabilities of a part's mean."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int"))
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-mean).alias("term"), F.array(F.exp(-mean)).alias("steps"))

    def more(acc: Column, k: Column) -> Column:
        term = acc.term * mean / k
        return F.struct(term.alias("term"),
                        F.concat(acc.steps, F.array(F.element_at(acc.steps, -1) + term)).alias("steps"))

    return sources.withColumn("parts", parts).withColumn("steps", F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)), start, more)["steps"])


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None, scale: float = 1.0,
          seed: str = SEED) -> DataFrame:
    """The columns of ``docs``, copy (from 1) and order_key, in shuffled order."""
    columns = [c for c in docs.columns if c not in ("copy", "order_key")]
    sources = written(with_distribution(rates(docs, weights, scale)), "rates")
    keyed = docs.select(*columns, F.coalesce("source", F.lit(NULL)).alias("_source"),
                        F.coalesce(F.col("doc_id").cast("string"), F.concat(
                            F.lit("row "), F.monotonically_increasing_id().cast("string"))).alias("_id"))
    if sources.count() <= BROADCAST_SOURCES:  # a row has 80 numbers: 15 MB at most
        drawn = keyed.join(F.broadcast(sources), "_source")
    else:
        drawn = salted_join(keyed, sources, "_source", "_id")

    def copies(part: Column) -> Column:
        at = unit(F.lit(seed), "_id", part.cast("string"))
        return F.size(F.filter("steps", lambda s: s <= at))

    number = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda n, j: n + copies(j))
    many = drawn.withColumn("_n", number).where("_n > 0").select(
        *columns, "_id", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    key = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), "_id", F.col("copy").cast("string"))
                            .cast("binary")), 1, 16)
    ranges = partitions(docs.sparkSession)
    place = (F.conv(F.substring("order_key", 1, 8), 16, 10).cast("double") * ranges / float(1 << 32)).cast("int")
    return (many.select(*columns, "copy", key.alias("order_key")).repartitionById(ranges, place)
            .sortWithinPartitions("order_key", "doc_id", "copy"))
