"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.llm import chat_format, decontaminate, exact_dedup, html_extract, jaccard_join, langid, mixing, quality, toxicity, url_filter
from quern.llm.common import spread, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(spread(table(spark, sf_dir, "pages")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_classes(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(spread(table(spark, sf_dir, "pages")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_quality(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spread(table(spark, sf_dir, "documents")))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_links(spread(table(spark, sf_dir, "documents")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_url_filter, op2_exact_dedup, op3_chat_format, op4_toxicity, op5_html_extract, op6_decontaminate, op7_quality, op8_language_id, op9_jaccard_join, op10_mixing)
    return {f.__name__: f for f in found}


OP2_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM t JOIN g USING (text)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": url_filter.filter_sql(), "op2_exact_dedup": OP2_SQL, "op3_chat_format": chat_format.FORMAT_SQL, "op10_mixing": mixing.mix_sql()}
