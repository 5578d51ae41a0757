"""Connected components of an edge table, by alternating large and small stars.

A graph of at most ``FEW_EDGES`` different edges is joined by one task in a single pass: a round
costs the driver some sixteen jobs, each with a task for every shuffle partition, and what it keeps
of them, however small the graph.  Larger graphs take rounds.

Each round is one aggregation and one join over the edges, written below the shared folder, so
neither the driver nor one task ever holds a component of a larger graph.  A node of very many neighbours costs the
aggregation one row per map task; for the join its edges are dealt over salts, and its row is
copied to each of them.  How many salts a node gets is known from its degree.  At most ``HUBS``
nodes can have a degree above 2 E / HUBS of E edges, so the table of them is small enough to be
broadcast, whatever the graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import drop_table, ship, through_table

#: Most nodes that are dealt over salts, and the edges of a node that one task takes at least.
HUBS, DEGREE = 50_000, 128
#: Edges that one task joins by itself (16 MB of them; ``roots_of`` takes 110 to 115 MB meanwhile).
FEW_EDGES = 1 << 20


def met(rows: DataFrame, totals: DataFrame, key: str, spread_by: str, limit: int) -> DataFrame:
    """``rows`` joined with ``totals`` by ``key``; the latter has n, how many rows a key has.  Rows of
    a key of more than ``limit`` are dealt over salts by a hash of ``spread_by``."""
    salts = F.ceil(F.col("n") / limit).cast("int")
    hubs = F.broadcast(totals.where(F.col("n") > limit).select(key, salts.alias("salts")))
    dealt = rows.join(hubs, key, "left").withColumn("salt", F.pmod(F.xxhash64(spread_by), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    copied = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1))).drop("n")
    return dealt.join(copied.hint("merge"), [key, "salt"]).drop("salt")


def hub_limit(rows: int) -> int:
    """The degree above which a node is dealt over salts: at most ``HUBS`` nodes of ``rows`` have it."""
    return max(DEGREE, 2 * rows // HUBS)


def _large_star(edges: DataFrame, limit: int) -> DataFrame:
    """Join each larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
    return met(both.where("b > a"), least, "a", "b", limit).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, limit: int) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them.  Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    down = met(edges, least, "a", "b", limit).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(down).distinct()


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, in order, and the smallest node of each one's component."""
    nodes, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ids[: len(a)], ids[len(a) :]
    up = np.arange(len(nodes))
    while len(x):
        # The larger root of an edge goes below the smallest root it meets; then all point to roots.
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up, after := up[up]):
            up = after
        x, y = up[x], up[y]
        x, y = x[x != y], y[x != y]
    return nodes, nodes[up]


def _joined_by_one(edges: DataFrame) -> DataFrame:
    """node, root of a graph that fits one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches if batch.num_rows]
        if not held:
            return
        found = roots_of(*(np.concatenate(c) for c in zip(*held, strict=True)))
        for at in range(0, len(found[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)], pa.int64()) for c in found], names=["node", "root"])

    ship(edges.sparkSession)
    return edges.coalesce(1).mapInArrow(run, "node long, root long")


def components(edges: DataFrame, label: str, most_rounds: int = 60) -> DataFrame:
    """node, root (smallest node of its component), for every node that has an edge to another.

    ``edges`` has two comparable columns a and b of one type; direction and repeats are free.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = through_table(edges, f"{label}-edges")
    seen, n = None, edges.count()
    if n <= FEW_EDGES and {kind for _, kind in edges.dtypes} == {"bigint"}:
        found = through_table(_joined_by_one(edges), f"{label}-roots")
        drop_table(edges)
        return found
    for _ in range(most_rounds):
        limit = hub_limit(n)
        after = through_table(_small_star(_large_star(edges, limit), limit), f"{label}-round")
        # Stars are a fixed point: one edge per node, and no root is itself below another.
        state = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first()
        drop_table(edges)
        edges, n = after, state[0]
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
