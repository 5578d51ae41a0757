"""Token and instruction-tuning passes: splits, offsets, turns, prompts, batches, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T


def in_validation(text_id: Column, modulus: int = 50) -> Column:
    """By the first eight hex digits of the id."""
    return F.conv(F.substring(text_id, 1, 8), 16, 10).cast("long") % modulus == 0


def running_starts(totals: DataFrame, by: list[str], chunk: str, names: list[str], width: int = 4096) -> DataFrame:
    """``by``, chunk and, for each of ``names``, ``<name>_start``: its sum over all chunks before.

    Sums run inside groups of ``width`` chunks and over the groups' totals, so the one task that
    sees all of a ``by`` has a row for ``width`` chunks, not for each.
    """
    held = totals.withColumn("_far", F.floor(F.col(chunk) / width))
    upto = lambda *keys: Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = lambda w, c, at: F.coalesce(F.sum(c).over(w.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    far = held.groupBy(*by, "_far").agg(*(F.sum(n).alias(f"_{n}") for n in names))
    far = far.select(*by, "_far", *(before(upto(*by), f"_{n}", "_far").alias(f"_{n}") for n in names))
    near = held.select(*by, chunk, "_far", *(before(upto(*by, "_far"), n, chunk).alias(n) for n in names))
    return near.join(far, [*by, "_far"]).select(*by, chunk, *((F.col(n) + F.col(f"_{n}")).cast("long").alias(f"{n}_start") for n in names))


def token_offsets(records: DataFrame, chunk: int = 1024) -> DataFrame:
    """ord, split, n_tokens, offset: where each record's tokens begin in its split's stream.

    The running sum is taken inside chunks of ``ord`` and over chunk totals, so no task holds a
    whole split.
    """
    rows = records.select("ord", F.when(in_validation(F.sha1(T.filled("text"))), "val").otherwise("train").alias("split"), F.size(T.words(T.filled("text"))).cast("long").alias("n_tokens")).withColumn("chunk", F.floor(F.col("ord") / chunk))
    inside = Window.partitionBy("split", "chunk").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("split", "chunk").agg(F.sum("n_tokens").alias("t"))
    starts = running_starts(totals, ["split"], "chunk", ["t"])
    return rows.withColumn("local", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(starts, ["split", "chunk"]).select("ord", "split", "n_tokens", (F.col("t_start") + F.col("local")).alias("offset"))


def turn_pairs(turns: DataFrame) -> DataFrame:
    """conv_id, turn, user, assistant: an answer paired with the user turn right before it."""
    talk = turns.where(F.col("role").isin("user", "assistant"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    seen = talk.withColumns({"_role": F.lag("role").over(w), "_text": F.lag("text").over(w)})
    return seen.where("role = 'assistant' and _role = 'user'").select("conv_id", "turn", F.col("_text").alias("user"), F.col("text").alias("assistant"))


def prompt(instruction: Column) -> Column:
    # The prompt's frame.
    return F.concat(F.lit("### Instruction:\n"), T.strip(instruction), F.lit("\n\n### Response:\n"))


def chat_context(turns: DataFrame, last: int = 6) -> DataFrame:
    """The last turns of each conversation."""
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return turns.withColumn("back", F.row_number().over(w)).where(F.col("back") <= last).select("conv_id", "turn", "role", "back")


def padded_batches(examples: DataFrame, size: int = 8, pad: int = 0) -> DataFrame:
    """batch, ord, ids, targets from (ord, ids): padded to the longest of the batch, -1 where masked.

    Batches are cut from ``ord``, so the only shuffle is by batch.
    """
    rows = examples.withColumn("batch", F.floor(F.col("ord") / size).cast("long"))
    width = F.max(F.size("ids")).over(Window.partitionBy("batch"))
    n = F.size("ids")
    shifted = F.slice("ids", 2, F.greatest(n - 1, F.lit(0)))
    return rows.withColumn("_w", width).select("batch", "ord", F.concat("ids", F.array_repeat(F.lit(pad), (F.col("_w") - n))).alias("ids"), F.concat(shifted, F.array_repeat(F.lit(-1), F.col("_w") - F.size(shifted))).alias("targets"))


def shard_plan(records: DataFrame, shard_bytes: int = 4_000_000, min_chars: int = 50, chunk: int = 1024, max_docs: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """ord, n_bytes, before, shard: a shard for each record by the bytes before it.

    With a cap the plan ends behind the record that reaches it.
    """
    rows = records.withColumn("_t", T.strip(T.filled("text"))).where(F.length("_t") >= min_chars).select("ord", F.octet_length("_t").cast("long").alias("n_bytes"), F.lit(1).cast("long").alias("n_docs")).withColumn("chunk", F.floor(F.col("ord") / chunk))
    inside = Window.partitionBy("chunk").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("chunk").agg(F.sum("n_bytes").alias("bytes"), F.sum("n_docs").alias("docs"))
    placed = rows.join(running_starts(totals, [], "chunk", ["bytes", "docs"]), "chunk")
    placed = placed.withColumns({"before": F.col("bytes_start") + F.coalesce(F.sum("n_bytes").over(inside), F.lit(0)), "place": F.col("docs_start") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))})
    if max_docs is not None:
        placed = placed.where(F.col("place") < max_docs)
    if max_bytes is not None:
        placed = placed.where(F.col("before") < max_bytes)
    return placed.select("ord", "n_bytes", "before", F.floor(F.col("before") / shard_bytes).cast("long").alias("shard"))


def cache_lookup(files: DataFrame, cache: DataFrame) -> DataFrame:
    """``files`` (ord, hash) with the cached text, null where it must be extracted."""
    return files.join(cache.select("hash", F.col("text").alias("cached")), "hash", "left")


def stem_diversity(instructions: DataFrame, col: str = "text", k: int = 4) -> DataFrame:
    """n, stems: rows, and distinct beginnings of ``k`` words."""
    stem = F.array_join(F.slice(T.words(F.lower(T.filled(col))), 1, k), " ")
    return instructions.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(stem).alias("stems"))
