"""Thin command line: ``python -m quern.cli ingest|audit|dedup-report|classify ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import doctype, neardup, passes
from quern.session import local_session
from quern.sources import manifest, sinks

RECORD = "ord long, source string, system string, doc_type string, license string, publishable boolean, text string"


def ingest(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Files named by a manifest to corpus records."""
    files = manifest.scan(spark, a.input, manifest.load(a.manifest)).where("text is not null")
    # A range sort and ids that rise over its partitions, fixed by writing them down once.
    ordered = files.orderBy("spec", "source").withColumn("ord", F.monotonically_increasing_id()).drop("spec")
    return passes.build_corpus(neardup.through_table(ordered))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="quern")
    p.add_argument("command", choices=("ingest", "audit", "dedup-report", "classify"))
    p.add_argument("input", help="a folder of files (ingest) or of JSON lines")
    p.add_argument("output")
    p.add_argument("--manifest")
    p.add_argument("--threshold", type=float, default=0.75)
    a = p.parse_args(argv)
    spark = spark or local_session()
    if a.command == "ingest":
        sinks.write_jsonl(ingest(spark, a), a.output)
        return
    records = spark.read.schema(RECORD).json(a.input)
    if a.command == "audit":
        out = passes.audit(records)
        print(json.dumps({r["verdict"]: r["count"] for r in out.groupBy("verdict").count().collect()}))
        sinks.write_jsonl(passes.worst_first(out), a.output, None)
    elif a.command == "dedup-report":
        sinks.write_jsonl(neardup.keep_drop(records, a.threshold), a.output, "drop")
    else:
        sinks.write_jsonl(doctype.classify(records), a.output)


if __name__ == "__main__":
    main()
