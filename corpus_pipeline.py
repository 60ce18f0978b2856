"""A training corpus from ``documents``: each stage reads what the last one wrote.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, all but the last with the columns of ``docs``.  ``run``
applies them to the whole table.

1. quality: documents that the boosted trees reject go.
2. near_duplicates: five-word shingles, similarity 0.8; the smallest doc_id of
   each group stays.
3. substrings: words in a 35-word window that occurs elsewhere are cut out; a
   document may be left with an empty text, but no row goes.
4. benchmark: documents that overlap a benchmark passage go.
5. mixing: Poisson copies towards square-root source weights, shuffled; adds
   ``copy`` and ``order_key``.

Null and empty texts pass stages 2 to 5 unchanged and are scored like any other
text in stage 1; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reachlens.llm import decontaminate, mixing, quality, setsketch, substring
from reachlens.llm.common import written

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return setsketch.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def _substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.deduplicated(docs)


def _benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [("quality", _quality), ("near_duplicates", _near_duplicates), ("substrings", _substrings),
          ("benchmark", _benchmark), ("mixing", _mixing)]

ORACLE_SQL = None  # a trained classifier is not SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
