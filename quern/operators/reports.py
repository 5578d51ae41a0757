"""What the passes did: counters of the corpus build and of the repair pass, reports in their order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import neardup, passes, repair
from quern.session import through_table


def build_with_counts(records: DataFrame, sep: str = "\n\n") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The corpus, one row of counters, and documents and characters by system.

    Each stage goes through a table, so counting it costs a reading of that table.  What the
    paragraph pass empties counts with the near copies.
    """
    gated = through_table(records.where(passes.is_quality(T.filled("text"))), "gated")
    unique = through_table(passes.exact_dedup(gated), "unique")
    corpus = through_table(neardup.minhash_dedup(passes.paragraph_dedup(unique, sep=sep)).withColumn("id", F.sha1("text")), "corpus")
    n_all, n_good, n_unique = (df.count() for df in (records, gated, unique))
    counts = corpus.agg(
        F.lit(n_all - n_good).cast("long").alias("dropped_low_quality"),
        F.lit(n_good - n_unique).cast("long").alias("dropped_exact_dup"),
        (F.lit(n_unique) - F.count(F.lit(1))).cast("long").alias("dropped_near_dup"),
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("characters"),
    )
    by_system = corpus.groupBy("system").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).cast("long").alias("characters"))
    return corpus, counts, by_system


def pairs_by_overlap(pairs: DataFrame) -> DataFrame:
    """Overlapping pairs, the greatest overlap first."""
    return pairs.orderBy(F.desc("overlap"), "a", "b")


def clusters_by_overlap(drops: DataFrame) -> DataFrame:
    """keep, drops, most: what each kept record stands for, the greatest overlap first."""
    return drops.groupBy("keep").agg(F.count(F.lit(1)).alias("drops"), F.max("overlap").alias("most")).orderBy(F.desc("most"), "keep")


def clean_corpus(records: DataFrame, model: Callable[[str], str], most: int = 6000, max_docs: int | None = None, drop_failed: bool = False, targets: tuple[str, ...] = ("BAD", "WARN"), dry_run: bool = False) -> tuple[DataFrame | None, DataFrame]:
    """Records after the repair pass (None in a dry run) and the report: ord, source,
    old_verdict, new_verdict, action, reason of what was targeted.

    Targeted are records with a text whose verdict is in ``targets``, the first ``max_docs`` by
    ``ord`` if that is given; all others pass as they are.  The model is called once for each.
    """
    flagged = passes.audit(records.where(T.filled("text") != "")).where(F.col("verdict").isin(*targets)).select("ord")
    if max_docs is not None:
        flagged = flagged.orderBy("ord").limit(max_docs)
    flagged = through_table(flagged, "flagged")
    mine = through_table(repair.rewrite(records.join(flagged, "ord", "left_semi"), model, most), "rewritten")
    decided = through_table(repair.decisions(mine.select("ord", F.col("text").alias("old"), "new"), drop_failed, targets), "decided")
    report = decided.join(mine.select("ord", "source"), "ord").select("ord", "source", "old_verdict", "new_verdict", "action", "reason")
    if dry_run:
        return None, report
    others = records.join(flagged, "ord", "left_anti")
    return others.unionByName(repair.apply_decisions(mine, decided), allowMissingColumns=True), report


def repair_counts(report: DataFrame) -> DataFrame:
    """targeted, replaced, kept, dropped, unfaithful, from a report or from decisions."""
    some = lambda test, name: F.count(F.when(test, 1)).alias(name)
    targeted = F.col("reason") != "passed"
    return report.agg(
        some(targeted, "targeted"),
        some(F.col("action") == "replace", "replaced"),
        some(targeted & (F.col("action") == "keep"), "kept"),
        some(F.col("action") == "drop", "dropped"),
        some(F.col("reason") == "unfaithful", "unfaithful"),
    )
