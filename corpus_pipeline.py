"""The corpus pipeline: from raw documents to a mixed training order.

Each stage reads what the one before it wrote and hands on the columns of ``documents``; the
last adds the place of each document in the mix.

Defined results
    An empty table passes through every stage as an empty table with its columns.  Null and empty
    texts are scored like any other by the first stage; those that stay count as copies of each
    other, resemble nothing, and contain no benchmark item.  Rows without a doc_id take part; of
    copies, a row with an id stays before one without.  Rows equal in text and id are copies.  Ties
    are broken as the operators state.  Further columns pass through under their own names, except
    that those named like a column of the mix give way to it in the last stage.  Very long texts
    are read whole everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import decontaminate, exact_dedup, jaccard_join, mixing, quality
from quern.llm.common import drop_table, table, through_table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each distinct text stays."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return jaccard_join.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in the mix of sources."""
    return mixing.mix(docs)


STAGES = [
    ("quality", classify),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", decontaminate_benchmark),
    ("mix", mix),
]

#: The first, third and fourth stage are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  A stage's table goes once the next one's is written, so at
    most two copies of the corpus lie in the shared folder at a time."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = through_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_table(before)
        before = docs
    return docs
