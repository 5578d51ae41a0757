"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.session import drop_table, ship, spread, through_table  # noqa: F401 - shared with the operators

#: Largest Arrow batch handed to Python, in bytes; keeps a worker's memory flat on long texts.
ARROW_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Make a session ready for Python over texts: give the executors this package, and bound its
    Arrow batches by bytes, so that long texts cannot pile up.  A lower bound of the session stays."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name, None)
    if not (held and held.isdigit() and 0 < int(held) <= ARROW_BYTES):
        spark.conf.set(name, str(ARROW_BYTES))


def spare(docs: DataFrame, name: str) -> str:
    """``name``, with as many ``_`` behind it as keep it apart from the columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % modulus


def stratified_sample(rows: DataFrame, label: str, per_class: int, most_labels: int, seed: int = 7) -> DataFrame:
    """At most ``per_class`` rows of each of the ``most_labels`` most frequent labels: those whose
    ids have the least hashes.

    The bound holds whatever the table holds (repeated ids, labels without end): a share of the
    hashes that about twice the rows fall into goes on, tasks keep the first of them, and the
    window keeps ``per_class``.  What is kept depends on the rows alone, not on their partitions
    or on retried tasks.  The counts joined are ``most_labels`` rows.
    """
    draw, many = spare(rows, "_draw"), spare(rows, "_many")
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias(many)).orderBy(F.desc(many), label).limit(most_labels)
    drawn = rows.withColumn(draw, F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / float(1 << 53)).join(F.broadcast(counts), label)
    near = drawn.where(F.col(draw) * F.col(many) < 2 * per_class + 64)
    first = Window.partitionBy(label).orderBy(draw, *[c for c in rows.columns if c != label])
    rank = spare(rows, "_rank")
    return near.withColumn(rank, F.row_number().over(first)).where(F.col(rank) <= per_class).select(*rows.columns)


def labelled_docs(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int, seed: int = 7) -> DataFrame:
    """doc_id, text and label (0 or 1) of a bounded sample of the labelled documents that ``train``
    admits: at most ``per_class`` of each label.

    Several labels of one id count as their largest; of several texts of one id the first in
    order speaks for it.  The sample is joined by broadcast: it has 2 x ``per_class`` rows at
    most, whatever the corpus holds.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    sample = stratified_sample(rows, label, per_class, 2, seed)
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    return joined.groupBy("doc_id", label).agg(F.min("text").alias("text"))


def map_texts(df: DataFrame, row: Callable[[str], tuple], fields: list[tuple[str, pa.DataType]], ddl: str, keep: list[str], text: str = "text") -> DataFrame:
    """Apply ``row`` to each text (null: empty); return the ``keep`` columns and its fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [row(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            columns += [pa.array([g[i] for g in got], kind) for i, (_, kind) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *(n for n, _ in fields)])

    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, text).mapInArrow(run, f"{kept}, {ddl}")


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def sigmoid(x: float) -> float:
    if x >= 0:
        return 1.0 / (1.0 + float(np.exp(-min(x, 700.0))))
    e = float(np.exp(max(x, -700.0)))
    return e / (1.0 + e)
