"""Mixing sources to target weights by Pfair scheduling.

A source of weight w owns blocks of documents.  Its j-th block (from 1) may not run before
slot floor((j-1)/w) and must have run by slot ceil(j/w).  One block runs per slot; among the
released blocks the one with the earliest deadline runs.  The weights sum to one, so each
deadline is met and after every slot t a source has run between w*t - 1 and w*t + 1 blocks.

Weights are whole shares of their sum W, hence the schedule repeats every W slots.  It is a
function of the plan's parameters alone: W entries, computed once, carried as literals.  All
work on rows is native: rows are numbered inside their source in an order given by a hash of
the id (a shuffle of the source), chunk by chunk, with chunk offsets from a running sum.

Defined results
    sources without a weight of their own share the queue ``rest`` (null sources too); when a
    source has run out of blocks its later slots stay empty and the others keep their order,
    so no document is dropped or repeated; the last block of a source may be short; an empty
    table gives an empty result; rows that repeat an id each get a position, in the order of a
    hash of their columns (rows equal in all are interchangeable), and one id's rows are numbered
    in one task; rows without an id are spread by that hash; texts are not looked into; columns of the
    input named like a result column (in any case) give way to it.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from quern.llm.common import spare

#: Shares of the production mix; every other source shares ``rest``.
SHARES = {"src0": 12, "src1": 8, "src2": 8, "src3": 8, "src4": 8, "src5": 6, "src6": 6, "src7": 6, "src8": 4, "src9": 4}
REST_SHARE = 30
#: Documents in a block.
BLOCK = 16
#: Rows that one chunk of the numbering holds, about.
CHUNK_ROWS = 2048


def schedule(shares: list[int]) -> list[int]:
    """The queue that runs in each slot of one period, by earliest deadline first.

    Ties in the deadline go to the queue named first.  Queues are positions in ``shares``.
    """
    total = sum(shares)
    ran = [0] * len(shares)
    slots = []
    for t in range(total):
        ready = [(ceil(Fraction((ran[q] + 1) * total, s)), q) for q, s in enumerate(shares) if s > 0 and floor(Fraction(ran[q] * total, s)) <= t]
        deadline, queue = min(ready)
        assert deadline > t, "weights that sum to one leave no deadline missed"
        ran[queue] += 1
        slots.append(queue)
    return slots


def mix(docs: DataFrame, shares: dict[str, int] | None = None, rest: int = REST_SHARE, block: int = BLOCK, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``docs`` with queue, block_no, slot and position (unique; ascending is the mixed order)."""
    shares = SHARES if shares is None else shares
    names = [*shares, None]
    weights = [*shares.values(), rest]
    if any(w < 0 for w in weights) or rest <= 0:
        raise ValueError("shares must not be negative and the rest needs a share")
    period = sum(weights)
    slots = schedule(weights)
    turns = [[t for t, q in enumerate(slots) if q == k] for k in range(len(weights))]

    queue = F.lit(len(names) - 1)
    for k, name in enumerate(names[:-1]):
        if weights[k]:
            queue = F.when(F.col("source") == name, F.lit(k)).otherwise(queue)
    results = ("queue", "block_no", "slot", "position")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in results])
    # Rows without an id are spread by their contents; contents also fix the order of equal ids.
    own = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns if not isinstance(docs.schema[c].dataType, MapType)))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit(":"), own.cast("string"))))
    total, digits = docs.count(), 1
    while chunk_rows * 16**digits < total:
        digits += 1
    line, hashed, chunk, size, offset, rank = (spare(docs, n) for n in ("_queue", "_key", "_chunk", "_n", "_offset", "_rank"))
    tie = spare(docs, "_tie")
    rows = docs.withColumns({line: queue, hashed: key, tie: own}).withColumn(chunk, F.substring(hashed, 1, digits))

    inside = Window.partitionBy(line, chunk).orderBy(hashed, "doc_id", tie)
    sizes = rows.groupBy(line, chunk).agg(F.count(F.lit(1)).alias(size))
    before = Window.partitionBy(line).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(line, chunk, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(offset))
    ranked = rows.withColumn(rank, F.row_number().over(inside) - 1).join(offsets, [line, chunk])
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(offset))

    turn_of = F.array(*[F.array(*map(F.lit, x)) if x else F.array().cast("array<int>") for x in turns])
    share_of = F.array(*map(F.lit, weights))
    named = F.array(*[F.lit(n) if n is not None else F.lit("rest") for n in names])
    block_no = F.floor(F.col(rank) / F.lit(block)).cast("long")
    share = F.element_at(share_of, F.col(line) + 1)
    slot = F.floor(F.col("block_no") / share).cast("long") * period + F.element_at(F.element_at(turn_of, F.col(line) + 1), (F.col("block_no") % share + 1).cast("int"))
    placed = ranked.withColumn("block_no", block_no).withColumn("slot", slot)
    return placed.select(*docs.columns, F.element_at(named, F.col(line) + 1).alias("queue"), "block_no", "slot", (F.col("slot") * block + F.col(rank) % block).alias("position"))


def mix_sql(shares: dict[str, int] | None = None, rest: int = REST_SHARE, block: int = BLOCK) -> str:
    """The same mix as one recursive query over ``documents``, slot by slot."""
    shares = SHARES if shares is None else shares
    named = ", ".join(f"({k}, '{n}', {w})" for k, (n, w) in enumerate([*shares.items(), ("rest", rest)]))
    total = sum(shares.values()) + rest
    queues = len(shares) + 1
    pick = f"""list_min(list_transform(range({queues}), lambda q: CASE WHEN (ran[q+1]*{total})//w[q+1] <= t
        THEN ((((ran[q+1]+1)*{total}+w[q+1]-1)//w[q+1])*{queues}+q) END))"""
    return f"""
WITH RECURSIVE queues(q, name, w) AS (VALUES {named}),
plan(t, ran, w, ran_q, turn) AS (
  SELECT 0::BIGINT, [0::BIGINT FOR x IN range({queues})], (SELECT list(w::BIGINT ORDER BY q) FROM queues), -1::BIGINT, -1::BIGINT
  UNION ALL
  SELECT t + 1, list_transform(range({queues}), lambda q: ran[q+1] + CASE WHEN q = pick % {queues} THEN 1 ELSE 0 END), w, pick % {queues}, ran[pick % {queues} + 1]
  FROM (SELECT *, {pick} AS pick FROM plan WHERE t < {total})
),
turns AS (SELECT ran_q AS q, turn, t - 1 AS nth FROM plan WHERE t > 0),
ranked AS (
  SELECT doc_id, source, q, name, w, row_number() OVER (PARTITION BY q ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS r
  FROM (SELECT d.doc_id, d.source, coalesce(k.q, {queues - 1}) AS q FROM documents d LEFT JOIN queues k ON d.source = k.name AND k.q < {queues - 1}) JOIN queues USING (q)
)
SELECT doc_id, source, name AS queue, (r // {block})::BIGINT AS block_no, ((r // {block}) // w * {total} + nth)::BIGINT AS slot,
  (((r // {block}) // w * {total} + nth) * {block} + r % {block})::BIGINT AS position
FROM ranked JOIN turns ON ranked.q = turns.q AND (r // {block}) % w = turn"""
