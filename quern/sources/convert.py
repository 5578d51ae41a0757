"""A tree of files to a tree of readable texts, archives inside archives included.

A run can be ended at any time and started again: what lies in the output already, not older than
its source, is not converted again, and a text is in place only once it is whole.
"""

from __future__ import annotations

import lzma
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import passes, repair, spacing
from quern.session import ship, through_table
from quern.sources import binfiles, documents, extraction

#: Archives in archives that are opened, and the suffixes that may hold some.
DEPTH = 40
NESTED = frozenset({".zip", ".tar", ".tgz", ".tbz2", ".tbz", ".txz", ".gz", ".bz2", ".xz"})


def expand(name: str, data: bytes, known: dict[str, documents.Reader], depth: int = 0) -> Iterator[tuple[str, bytes | None]]:
    """(label, bytes) of a readable file, or of every one in an archive; None for an archive that
    cannot be read to its end."""
    if not documents.is_archive(name):
        if documents.suffix(name) in known:
            yield name, data
    elif depth < DEPTH:
        try:
            for label, body in documents.members(name, data, set(known) | NESTED):
                yield from expand(label, body, known, depth + 1)
        except (OSError, EOFError, zipfile.BadZipFile, tarfile.TarError, lzma.LZMAError, RuntimeError):
            yield name, None


def _files(spark: SparkSession, root: str) -> DataFrame:
    """path, rel (below ``root``), modificationTime, length, content; junk left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = root.rstrip("/").removeprefix("file:") + "/"
    rel = F.expr(f"substring(path, locate('{below}', path) + {len(below)})")
    name = F.element_at(F.split("path", "/"), -1)
    junk = F.col("path").contains("/__MACOSX/") | name.startswith("._") | name.isin(".DS_Store", "Thumbs.db")
    return files.withColumn("rel", rel).where(~junk)


def _opened(files: DataFrame, known: dict[str, documents.Reader], read: bool) -> DataFrame:
    """rel, label, text, failed of all that is in ``files``; texts only if ``read``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rel, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for label, body in expand(rel, data.as_py(), known):
                    text = next((t for _, t in documents.extract(label, body, known)), None) if read and body is not None else None
                    yield pa.RecordBatch.from_arrays([pa.array([rel]), pa.array([label]), pa.array([text], pa.string()), pa.array([body is None])], names=["rel", "label", "text", "failed"])

    return files.select("rel", "content").mapInArrow(run, "rel string, label string, text string, failed boolean")


def target(label: str = "label"):
    """Where a file's text lies below the output, without its ``.txt``: archives become folders."""
    return F.replace(F.col(label), F.lit("!"), F.lit("/"))


def finished(spark: SparkSession, out: str) -> DataFrame:
    """target, at of the texts that lie in the output already; empty ones count as missing."""
    try:
        return _files(spark, out).where("length > 0").select(F.expr("substring(rel, 1, length(rel) - 4)").alias("target"), F.col("modificationTime").alias("at"))
    except PySparkException:  # no output yet
        return spark.createDataFrame([], "target string, at timestamp")


def convert_tree(spark: SparkSession, src: str, out: str, readers: dict[str, documents.Reader] | None = None, min_chars: int = 200, force: bool = False, words: dict[str, int] | None = None) -> DataFrame:
    """Texts of the files below ``src`` at the same places below ``out``; one row of counts:
    converted, cached, rejected, skipped, archives, failed.

    Texts are repaired, reflowed and, with ``words`` (their counts), split where words ran
    together; what is short or of the verdict BAD is rejected.  Links are not followed.
    """
    ship(spark)
    known = documents.READERS | (readers or {})
    every = _files(spark, src)
    files = every.where(extraction.supported("path", known))
    held = through_table(_opened(files, known, False).drop("text").join(files.select("rel", "modificationTime"), "rel").withColumn("target", target()), "convert-held")
    wanted = held.where(~F.col("failed"))
    fresh = wanted.join(finished(spark, out), "target").where("at >= modificationTime").select("label")
    todo = wanted if force else wanted.join(fresh, "label", "left_anti")
    todo = through_table(todo.select("rel", "label", "target"), "convert-todo")
    raw = _opened(files.join(todo.select("rel").distinct(), "rel", "left_semi"), known, True).join(todo.select("label", "target"), "label")
    texts = repair.clean_text(raw.where("text is not null").select(F.col("target").alias("ord"), "text"))
    texts = texts.withColumn("text", T.reflow(F.col("text")))
    if words is not None:
        texts = spacing.repair_spacing(texts, words)
    texts = through_table(texts, "convert-texts")
    good = passes.audit(texts).where((F.col("verdict") != "BAD") & (F.col("n_chars") >= min_chars)).select("ord")
    kept = through_table(texts.join(good, "ord", "left_semi"), "convert-kept")
    binfiles.write_mirror(kept, out, "ord")
    n_todo, n_kept = todo.count(), kept.count()
    count = lambda n, name: F.lit(n).cast("long").alias(name)
    archive = F.lower("rel").rlike(r"\.(zip|tar|tgz|tbz2|tbz|txz|gz|bz2|xz)$")
    return held.agg(
        count(n_kept, "converted"),
        (F.count(F.when(~F.col("failed"), 1)) - n_todo).alias("cached"),
        count(n_todo - n_kept, "rejected"),
        count(every.where(~extraction.supported("path", known)).select("rel").count(), "skipped"),
        count(files.where(archive).select("rel").count(), "archives"),
        F.count(F.when(F.col("failed"), 1)).alias("failed"),
    )
