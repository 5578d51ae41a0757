"""Extraction with a cache: a file whose bytes were read before, by the same logic, is not read again.

The cache is a table of (hash, version, member, text).  It is a convenience: whatever is wrong with
it, the files are extracted and the run goes on.
"""

from __future__ import annotations

import logging
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import ship, through_table
from quern.sources import documents

#: Goes up whenever the same bytes would give another text.
LOGIC = 1
CACHE = "hash string, version string, member string, text string, at timestamp"

log = logging.getLogger(__name__)


def version(readers: dict[str, documents.Reader] | None = None) -> str:
    """What an extracted text depends on besides the bytes."""
    known = documents.READERS | (readers or {})
    return "|".join([f"logic {LOGIC}", f"python {sys.version_info[0]}.{sys.version_info[1]}", f"unicode {unicodedata.unidata_version}", "readers " + " ".join(sorted(known))])


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache's rows; none where there is no cache, or none that can be read."""
    try:
        rows = spark.read.schema(CACHE).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(path)
        rows.select("hash", "version").distinct().count()
        return rows
    except PySparkException as e:
        log.warning("no cache at %s: %s", path, str(e).split("\n")[0])
        return spark.createDataFrame([], CACHE)


def add_to_cache(fresh: DataFrame, path: str, tag: str) -> bool:
    """Whether ``fresh`` (hash, member, text) could be added."""
    try:
        fresh.select("hash", F.lit(tag).alias("version"), "member", "text", F.current_timestamp().alias("at")).write.mode("append").parquet(path)
        return True
    except PySparkException as e:
        log.warning("cache at %s not written: %s", path, str(e).split("\n")[0])
        return False


def supported(path: str, known: dict[str, documents.Reader]):
    """Whether a path is a file that a reader takes, or an archive."""
    name = F.lower(F.col(path))
    ends = [*known, ".zip", *documents.TAR, *documents.SINGLE]
    some = name.endswith(ends[0])
    for e in ends[1:]:
        some = some | name.endswith(e)
    return some


def _extracted(files: DataFrame, known: dict[str, documents.Reader]) -> DataFrame:
    """hash, member, text of files (path, hash, content); a file that gives nothing has a row
    without a member, so that it too is known next time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, digest, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = [(label[len(name) :], text) for label, text in documents.extract(name, data.as_py(), known)] or [(None, None)]
                for member, text in found:
                    yield pa.RecordBatch.from_arrays([pa.array([digest]), pa.array([member], pa.string()), pa.array([text], pa.string())], names=["hash", "member", "text"])

    return files.select("path", "hash", "content").mapInArrow(run, "hash string, member string, text string")


def cached_files(spark: SparkSession, path: str, cache: str | None, glob: str = "*", readers: dict[str, documents.Reader] | None = None) -> tuple[DataFrame, DataFrame]:
    """(source, sha256, text, cached) of every supported file below ``path``, and one row of counts:
    files_scanned, cache_hits, archives_expanded, skipped_unsupported.

    Files of equal bytes are read once.  ``cached`` says whether the text came from the cache.
    """
    ship(spark)
    known = documents.READERS | (readers or {})
    tag = version(readers)
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    junk = F.col("path").contains("/__MACOSX/") | name.startswith("._") | name.isin(".DS_Store", "Thumbs.db")
    listed = every.where(~junk)
    files = listed.where(supported("path", known))
    keys = through_table(files.select("path", F.sha2("content", 256).alias("hash")), "files")
    held = read_cache(spark, cache).where(F.col("version") == tag).dropDuplicates(["hash", "member"]) if cache else spark.createDataFrame([], CACHE)
    hits = keys.join(held.select("hash", "member", "text"), "hash").withColumn("cached", F.lit(True))
    todo = keys.join(held.select("hash").distinct(), "hash", "left_anti").groupBy("hash").agg(F.min("path").alias("path"))
    fresh = through_table(_extracted(todo.join(files.select("path", "content"), "path"), known), "extracted")
    if cache:
        add_to_cache(fresh, cache, tag)
    both = hits.unionByName(keys.join(fresh, "hash").withColumn("cached", F.lit(False)))
    rows = both.where("member is not null").select(F.concat("path", "member").alias("source"), F.col("hash").alias("sha256"), "text", "cached")
    archive = F.lower("path").rlike(r"\.(zip|tar|tgz|tbz2|txz|gz|bz2|xz)$")
    known_hash = held.select("hash").distinct().withColumn("hit", F.lit(True))
    counts = keys.join(known_hash, "hash", "left").agg(F.count(F.lit(1)).alias("files_scanned"), F.count("hit").alias("cache_hits"), F.count(F.when(archive, 1)).alias("archives_expanded"))
    return rows, counts.withColumn("skipped_unsupported", F.lit(listed.where(~supported("path", known)).select("path").count()).cast("long"))
