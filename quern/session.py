"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "quern", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: A table of fewer files than there are cores is dealt out anew up to this many bytes a core.
SPREAD_BYTES = 128 << 20


def spread(table: DataFrame) -> DataFrame:
    """``table`` over all cores, where its files cannot be: a small file is one row group, and so
    one task, whatever the machine has.  Larger tables are left as they are, so nothing is
    shuffled that fills the cores by itself."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > cores * SPREAD_BYTES or len(table.inputFiles()) >= cores:
        return table
    # Without the (empty) observation, filters would be moved below the exchange, into the one task.
    return table.repartition(cores, table.columns[0]).observe(f"spread_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each context: Spark serves the archive to them."""
    context = spark.sparkContext
    if getattr(context, "_quern_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quern-")) / "quern.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*")):
            if file.suffix in (".py", ".jsonl"):
                z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._quern_shipped = True


#: Spark's own limit of an Arrow batch, and the one that the passes over texts set instead.
ARROW_BYTES, BATCH_BYTES = 64 << 20, 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of about a megabyte: a worker holds one batch, what it makes of it, and little
    else, however large the table is.  A limit that the session was given is left alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in (str(ARROW_BYTES), f"{ARROW_BYTES}b"):
        spark.conf.set(key, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the context's
    checkpoint folder, else (one machine, tests) one of its own.  A cluster must name it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "/tmp/checkpoints"
    return named.rstrip("/")


def through_table(df: DataFrame, label: str = "pass") -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    The written table cuts the lineage: a lost executor costs no recomputation of what lies
    before it, and the plan behind is not run twice by two consumers.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``through_table`` wrote, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
