"""Chat formatting: collapse cumulative snapshots, then render what is left.

Chat logs often store a conversation again after each turn, so one conversation appears as a
chain of prefixes.  Each turn gets a hash of (place, role, text); the rolling hash of a prefix
is the xor of its turns' hashes over two independent 64-bit hashes (the place inside makes it
depend on the order).  A conversation whose whole hash equals a proper prefix hash of a longer
one is dropped by an anti-join; of equal conversations the smallest conv_id stays.

Native DataFrame code only.  Copies and common openings collapse in map-side aggregation
before the anti-join, so a first turn shared by a third of the conversations is one row.

Defined results
    turns are ordered by turn (null first), ties by role and text; a null role renders as ``unknown``
    and a null text as empty; rows without a conv_id belong to no conversation and are left
    out; turn rows that repeat count as turns of their own; a conversation is rendered whole, in
    one row of one task, however long it and its texts are; other columns are not read,
    whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|", "|>"


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, k (turns so far), n (turns in all), p1, p2: one row per turn."""
    rows = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # The whole text orders ties, as in the rendering; only the digests go beyond this window.
    hashed = rows.withColumns({"m": F.md5("text"), "x": F.xxhash64("text", F.lit(11))})
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = hashed.withColumn("k", F.row_number().over(order))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select(
        "conv_id",
        "k",
        F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n"),
        F.bit_xor(F.xxhash64("k", "role", "m", "x")).over(upto).alias("p1"),
        F.bit_xor(F.xxhash64(F.lit(97), "x", "m", "role", "k")).over(upto).alias("p2"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, copies: conversations that are no proper prefix of a longer one, one per content."""
    hashes = prefix_hashes(turns)
    whole = hashes.where("k = n").groupBy("k", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    proper = hashes.where("k < n").select("k", "p1", "p2").distinct()
    return whole.join(proper, ["k", "p1", "p2"], "left_anti").select("conv_id", "copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, copies, n_turns, n_chars, rendered: one row per maximal conversation."""
    kept = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text").join(maximal_conversations(turns).hint("merge"), "conv_id")
    turn = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = kept.groupBy("conv_id", "copies").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    line = F.transform("t", lambda x: F.concat(F.lit(OPEN), x["role"], F.lit(CLOSE + "\n"), F.trim(x["text"]), F.lit("\n" + OPEN + "end" + CLOSE)))
    return grouped.select("conv_id", "copies", F.size("t").cast("long").alias("n_turns"), F.array_join(line, "\n").alias("rendered")).withColumn("n_chars", F.length("rendered").cast("long"))


FORMAT_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), chats AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS t FROM turns GROUP BY conv_id
), one AS (
  SELECT min(conv_id) AS conv_id, count(*) AS copies, t FROM chats GROUP BY t
), proper AS (
  SELECT DISTINCT t[1:k] AS t FROM one, unnest(range(1, len(t))) AS u(k)
)
SELECT conv_id, copies, len(t)::BIGINT AS n_turns, rendered, length(rendered)::BIGINT AS n_chars
FROM (SELECT conv_id, copies, t, array_to_string(list_transform(t, lambda x: '<|' || x.role || '|>' || chr(10) || trim(x.text, ' ') || chr(10) || '<|end|>'), chr(10)) AS rendered
      FROM one WHERE t NOT IN (SELECT t FROM proper))"""
