"""Writers.  All go through Spark's committers, so a lost executor leaves no half file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import sft


def write_jsonl(records: DataFrame, path: str, order: str | None = "ord") -> None:
    """One object a line, files in the order of ``order``."""
    (records.orderBy(order) if order else records).write.mode("overwrite").json(path)


def write_shards(records: DataFrame, path: str, shard_bytes: int = 4_000_000, min_chars: int = 50, max_docs: int | None = None, max_bytes: int | None = None) -> None:
    """Texts, a blank line between them, in one folder a shard of about ``shard_bytes``, up to a cap."""
    plan = sft.shard_plan(records, shard_bytes, min_chars, max_docs=max_docs, max_bytes=max_bytes).select("ord", "shard")
    rows = records.select("ord", T.strip(T.filled("text")).alias("value")).join(plan, "ord")
    rows.repartition("shard").sortWithinPartitions("shard", "ord").select("shard", "value").write.mode("overwrite").partitionBy("shard").option("lineSep", "\n\n").text(path)


def upsert_cache(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """hash, version, text, at: the latest row of each (hash, version)."""
    both = cache.unionByName(fresh, allowMissingColumns=True)
    return both.groupBy("hash", "version").agg(F.max_by("text", "at").alias("text"), F.max("at").alias("at"))
