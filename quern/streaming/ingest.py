"""The corpus passes over records that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.functions import text as T
from quern.operators import passes

SCHEMA = "ord long, system string, source string, text string, arrived timestamp"


def arriving(spark: SparkSession, folder: str, schema: str = SCHEMA, files_per_batch: int = 64) -> DataFrame:
    """Records of the JSON-lines files that appear in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def admitted(records: DataFrame, within: str = "1 day") -> DataFrame:
    """Records that pass the quality gate, the first to arrive of each normal form.

    Copies are recognised while their first is at most ``within`` older: the state of the
    pass is the digests of that span, not of the stream.  For copies at any distance follow it
    with ``passes.exact_dedup`` over the written table.
    """
    gated = records.where(passes.is_quality(T.filled("text")))
    keyed = gated.withColumn("digest", F.sha1(T.norm(T.filled("text")))).withWatermark("arrived", within)
    return keyed.dropDuplicatesWithinWatermark(["digest"])


def counted(records: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """system, start, documents, kept, characters of each window of arrival."""
    ok = passes.is_quality(T.filled("text"))
    by = records.withWatermark("arrived", late).groupBy("system", F.window("arrived", window).alias("w"))
    sums = by.agg(F.count(F.lit(1)).alias("documents"), F.sum(ok.cast("long")).alias("kept"), F.sum(F.length(T.filled("text")).cast("long")).alias("characters"))
    return sums.select("system", F.col("w.start").alias("start"), "documents", "kept", "characters")


def append(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there now as Parquet and end; started again it goes on where it was."""
    return records.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
