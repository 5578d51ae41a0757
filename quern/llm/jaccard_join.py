"""N-gram Jaccard join: an exact metric-space self-join of word-shingle sets.

The Jaccard distance d = 1 - |A & B| / |A | B| is a metric.  Documents link at d <= r = 0.2.

1.  *Classes.*  Documents with equal shingle sets are one point.
2.  *Pre-split.*  Two linked sets share an element among the first n - ceil(0.8 n) + 1 of each,
    under any common order of elements; rare elements come first, so passages that many
    documents share come last.  Sets connected by shared first elements form a region; no link
    leaves a region.  (Nearly all distances in a corpus are one: pivots over all of it would
    tell nothing apart.)
3.  *Voronoi cells.*  Pivots are picked in a region.  A set belongs to the cell of its nearest
    pivot, or, farther than T = 0.6 from all, to the cell of the far ones.  By the triangle
    inequality a set y links into the cell of p only if d(y, p) <= T + r and
    d(y, p) <= d(y, nearest) + 2 r, and with a far set only if d(y, nearest) > T - r: there it is
    replicated as a guest (of two cells' members only the later one's, so each pair meets once).
    Every cell with its guests is a region again and is joined recursively: inside one task if
    it is small, else in the next round, split anew by its first elements (of an order by counts
    inside the region) and with more pivots.
4.  *Components.*  Links give connected components; a component's id is the smallest doc_id in it.
5.  *Link counts.*  Where they are asked for, every pair of linked sets is met once, and tasks
    return sums for each class, weighted by the rows of the classes it links with, never the
    links themselves.  Where they are not, a region whose sets are all tied to one pivot is done.

Element counts are taken over the whole corpus, but only serve as the order in step 2: any
order gives the same links.  Elements are 64-bit hashes of shingles, classes have 128-bit keys
(64 bits of them name a class inside its region).  What tasks carry of the counts has a fixed
size: those of the ``HEAVY`` most frequent elements, and a map of 2**``MAP_BITS`` bits (16 MB) of
the elements that repeat at all.  A task holds up to ``REGION`` sets of a region and about
``ELEMENTS`` elements, besides one set's own.

Defined results
    null and empty texts and texts of white space have an empty set, n_shingles 0, and link
    with nothing (their component_id is their own doc_id); fewer than five words make one
    shingle; repeated rows link with each other; rows that share a doc_id but not their text are
    rows of their own; rows without a doc_id take part, and a component of such rows only has the
    component_id null; an empty table gives an empty result; very long texts are read whole.  A
    row's n_links is the number of other rows it links with.  Other columns, whatever their
    names, are not read; ``keep_one`` passes them on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.llm.common import bounded_batches, drop_table, spare, through_table
from quern.llm.components import components, hub_limit, met

WORDS = 5
#: Two sets link when PERCENT * union <= 100 * intersection.
PERCENT = 80
RADIUS = 1 - PERCENT / 100
EPS = 1e-9
#: Elements whose counts the order uses, and the size (a power of two) of the map of repeated ones.
HEAVY, MAP_BITS = 1 << 17, 27
#: Parts in which the map comes to the driver, one after the other, a job for each.
MAP_PARTS = 8
#: Sets that one task joins by itself; pivots of the first round over a larger region (four times
#: as many in each further one, up to the last number); elements that a task holds, about.
REGION, PIVOTS, MOST_PIVOTS, ELEMENTS = 512, 16, 256, 1 << 23
#: Blocks of so many sets or elements up to which a region is joined block by block, without a round.
BLOCKS = 8
#: Radius of a cell; sets that are compared without pivots; pivots inside a task.
FAR, FEW, INNER_PIVOTS = 0.6, 48, 8
#: Elements gathered before they are packed for a shuffle.
CHUNK = 1 << 19
#: Cells of a matrix of sets by elements; wider ones are multiplied in parts.
CELLS = 1 << 22

_U = np.uint64
_BASE, _STEP, _SHORT = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        out = np.empty(size, _U)
        out[0] = 1
        done = 1
        while done < size:
            more = min(done, size - done)
            out[done : done + more] = out[:more] * _U(pow(base, done, 1 << 64))
            done += more
        _powers[base] = have = out
    return have


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(_STEP)
    h = (h ^ (h >> _U(27))) * _U(_SHORT)
    return h ^ (h >> _U(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[1], blank.view(np.int8), [1]]))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, _U)
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    total = np.cumsum((low.astype(_U) + _U(1)) * _power(_BASE, len(low))[: len(low)])
    before = np.where(start > 0, total[start - 1], _U(0))
    words = _mix((total[end - 1] - before) * _power(_INVERSE, len(low))[start] + (end - start).astype(_U) * _U(_STEP))
    if len(words) < WORDS:
        h = _U(len(words) * _SHORT % (1 << 64))
        for w in words:
            h = _mix(np.array([h]) * _U(_BASE) + w)[0]
        return np.array([h], _U)
    h = words[: len(words) - WORDS + 1]
    for k in range(1, WORDS):
        h = h * _U(_BASE) + words[k : len(words) - WORDS + 1 + k]
    return np.unique(_mix(h))


def set_key(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit key of a set, as two signed 64-bit numbers."""
    return int(s.sum(dtype=_U).view(np.int64)) if len(s) else 0, int(_mix(s ^ _U(_BASE)).sum(dtype=_U).view(np.int64)) if len(s) else 0


def needed(n: int) -> int:
    """Elements that a set of n shares with any set it links with."""
    return (PERCENT * n + 99) // 100


def linked(inter, n_a, n_b):
    """Whether sets of n_a and n_b elements with ``inter`` in common link (exact, whole numbers)."""
    return 100 * inter >= PERCENT * (n_a + n_b - inter)


# ---------------------------------------------------------------- packing for shuffles


def pack(a: np.ndarray) -> bytes:
    """Sorted uint32 as four byte planes: the upper ones are near constant and compress away."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _split(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The range (upper bits) and the 32 bits after it."""
    return (values >> _U(64 - bits)).astype(np.int64), ((values >> _U(32 - bits)) & _U(0xFFFFFFFF)).astype(np.uint32)


def _group_bounds(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(key, from, to) of each run of a sorted array."""
    cut = np.flatnonzero(np.diff(keys)) + 1
    return [(int(keys[a]), int(a), int(b)) for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)], strict=True)] if len(keys) else []


def _texts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[np.ndarray]:
    for batch in batches:
        for t in batch.column(batch.schema.get_field_index(column)).to_pylist():
            yield shingles(t)


def _runs(batches: Iterator[pa.RecordBatch], key: str, columns: tuple[str, ...], once: int = 0) -> Iterator[tuple[int, list[list]]]:
    """Rows of consecutive equal keys, as lists of column values; rows arrive sorted by the key.
    A row that repeats the first ``once`` columns of the row before it is left out."""
    at, held = None, [[] for _ in columns]
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
        values = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
        for i, k in enumerate(keys):
            if k != at and held[0]:
                yield at, held
                held = [[] for _ in columns]
            at = k
            if once and held[0] and all(held[c][-1] == values[c][i] for c in range(once)):
                continue
            for h, v in zip(held, values, strict=True):
                h.append(v[i])
    if held[0]:
        yield at, held


# ---------------------------------------------------------------- 1. classes


def located(docs: DataFrame) -> DataFrame:
    """doc_id, place, text: id and a hash of the text find a row again."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")), F.lit(5)).alias("place"), "text")


def classes_of(docs: DataFrame) -> DataFrame:
    """doc_id, place, n, k1, k2 for each row of ``docs``."""

    def run(batches):
        for batch in batches:
            n, k1, k2 = [], [], []
            for t in batch.column(2).to_pylist():
                s = shingles(t)
                a, b = set_key(s)
                n.append(len(s))
                k1.append(a)
                k2.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())], names=["doc_id", "place", "n", "k1", "k2"])

    return located(docs).mapInArrow(run, "doc_id long, place long, n long, k1 long, k2 long")


# ---------------------------------------------------------------- 2. regions


def element_counts(docs: DataFrame, bits: int) -> DataFrame:
    """How many rows hold each element (its upper ``bits`` + 32 bits) that more than one holds.

    Counts run over all documents.  Tasks send packed runs of elements, one for each range; a
    range is added up in one task, of the size that ``bits`` sets.  A row is a range's elements
    of one tier (a quarter of a power of two) of the count.
    """

    def emit(batches):
        held, size = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            ranges, rest = _split(values, bits)
            bounds = _group_bounds(ranges)
            many = [np.flatnonzero(counts[a:b] > 1) for _, a, b in bounds]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _, _ in bounds], pa.int64()),
                    pa.array([pack(rest[a:b]) for _, a, b in bounds], pa.binary()),
                    pa.array([m.astype("<u4").tobytes() for m in many], pa.binary()),
                    pa.array([counts[a:b][m].astype("<u4").tobytes() for (_, a, b), m in zip(bounds, many, strict=True)], pa.binary()),
                ],
                names=["r", "v", "i", "c"],
            )

        drop = _U(32 - bits)
        for s in _texts(batches):
            held.append(s >> drop << drop)
            size += len(s)
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def add_up(batches):
        for r, (v, i, c) in _runs(batches, "r", ("v", "i", "c")):
            counts = []
            for blob, where, more in zip(v, i, c, strict=True):
                one = np.ones(len(blob) // 4, np.int64)
                one[np.frombuffer(where, "<u4")] = np.frombuffer(more, "<u4")
                counts.append(one)
            values = np.concatenate([unpack(x) for x in v])
            order = np.argsort(values, kind="stable")
            values, counts = values[order], np.concatenate(counts)[order]
            first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            values, counts = values[first], np.add.reduceat(counts, first)
            values, counts = values[counts > 1], counts[counts > 1]
            tiers = np.floor(np.log2(counts) * 4).astype(int) if len(counts) else counts
            rows = [(r, int(t), values[tiers == t], counts[tiers == t]) for t in np.unique(tiers)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int32()), pa.array([len(x[2]) for x in rows], pa.int64()), pa.array([pack(x[2]) for x in rows], pa.binary()), pa.array([x[3].astype("<u4").tobytes() for x in rows], pa.binary())],
                names=["r", "tier", "n", "v", "c"],
            )

    packed = docs.select("text").mapInArrow(emit, "r long, v binary, i binary, c binary")
    return through_table(packed.repartition("r").sortWithinPartitions("r").mapInArrow(add_up, "r long, tier int, n long, v binary, c binary"), "jaccard-counts")


def _lowest_tier(table: DataFrame, most: int) -> int | None:
    """The lowest tier such that at most ``most`` elements are in it or above."""
    lowest, total = None, 0
    for s in sorted(table.groupBy("tier").agg(F.sum("n").alias("n")).collect(), key=lambda s: -s.tier):
        total += s.n
        if total > most:
            break
        lowest = s.tier
    return lowest


def most_frequent(table: DataFrame, most: int = HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent elements (sorted) and their counts: at most ``most``, as counted before any is collected."""
    lowest = _lowest_tier(table, most)
    rows = table.where(F.col("tier") >= lowest).select("r", "v", "c").collect() if lowest is not None else []
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    e = np.concatenate([unpack(x.v).astype(np.int64) | (x.r << 32) for x in rows])
    n = np.concatenate([np.frombuffer(x.c, "<u4") for x in rows]).astype(np.int64)
    order = np.argsort(e)
    return e[order], n[order]


def repeated_map(table: DataFrame, bits: int, size: int) -> np.ndarray:
    """A map of 2**size bits, set where an element occurs more than once.

    Its size is fixed by the caller.  Where too many elements repeat for it, it marks those of
    the higher tiers only, at most a quarter as many as it has bits.
    """
    out = np.zeros((1 << size) // 8, np.uint8)
    lowest = _lowest_tier(table, 1 << (size - 2))
    if lowest is None:
        return out
    local = size - bits

    def run(batches):
        for r, (v,) in _runs(batches, "r", ("v",)):
            own = np.zeros(1 << local, bool)
            for blob in v:
                own[unpack(blob) >> np.uint32(32 - local)] = True
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int64()), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], names=["r", "m"])

    for x in table.where(F.col("tier") >= lowest).select("r", "v").repartition("r").sortWithinPartitions("r").mapInArrow(run, "r long, m binary").coalesce(MAP_PARTS).toLocalIterator():
        width = (1 << local) // 8
        out[x.r * width : (x.r + 1) * width] = np.frombuffer(x.m, np.uint8)
    return out


def first_elements(s: np.ndarray, heavy: np.ndarray, counts: np.ndarray, repeated: np.ndarray, bits: int) -> np.ndarray:
    """The elements of a set that come first: rare before frequent, then by value."""
    take = len(s) - needed(len(s)) + 1
    size = (len(repeated) * 8).bit_length() - 1
    at = (s >> _U(64 - size)).astype(np.int64)
    rank = ((repeated[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64)
    once = np.flatnonzero(rank == 0)
    if len(once) >= take:
        return s[once[:take]]
    if len(heavy):
        short = (s >> _U(32 - bits)).astype(np.int64)
        at = np.searchsorted(heavy, short)
        at[at == len(heavy)] = 0
        rank = np.where(heavy[at] == short, counts[at], rank)
    return s[np.lexsort((s, rank))[:take]]


def region_edges(docs: DataFrame, bits: int, heavy: np.ndarray, counts: np.ndarray, repeated: np.ndarray) -> DataFrame:
    """Edges (a, b) between class keys k1: a star for each run of sets that share a first element.

    Runs are cut where the next larger set has more than two size steps (of a quarter) on the
    set before, so that no link can cross the cut.
    """
    carried = docs.sparkSession.sparkContext.broadcast((heavy, counts, repeated))

    def emit(batches):
        heavy, counts, repeated = carried.value
        held, nodes, sizes, size, seen = [], [], [], 0, set()

        def flush():
            e = np.concatenate(held)
            lengths = [len(h) for h in held]
            node, step = np.repeat(np.array(nodes, np.int64), lengths), np.repeat(np.array(sizes, np.uint8), lengths)
            order = np.lexsort((node, step, e))
            e, node, step = e[order], node[order], step[order]
            # Sets of one size step that share an element here are tied here; the least goes on.
            new = np.concatenate([[True], (e[1:] != e[:-1]) | (step[1:] != step[:-1])])
            least = node[new][np.cumsum(new) - 1]
            ties = np.unique(np.stack([node, least], 1)[node != least], axis=0)
            e, node, step = e[new], node[new], step[new]
            ranges, rest = _split(e, bits)
            bounds = _group_bounds(ranges)
            rows = [(k, pack(rest[a:b]), node[a:b].astype("<i8").tobytes(), step[a:b].tobytes()) for k, a, b in bounds]
            # Ties travel as they are, dealt over the ranges, without size steps.
            rows += [(int(ties[at, 0]) & ((1 << bits) - 1), ties[at : at + 4096, 0].astype("<i8").tobytes(), ties[at : at + 4096, 1].astype("<i8").tobytes(), None) for at in range(0, len(ties), 4096)]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), *(pa.array([x[c] for x in rows], pa.binary()) for c in (1, 2, 3))], names=["r", "v", "x", "z"])

        for s in _texts(batches):
            key = set_key(s)
            if not len(s) or key in seen:  # a copy within the chunk adds nothing
                continue
            seen.add(key)
            held.append(first_elements(s, heavy, counts, repeated, bits))
            nodes.append(key[0])
            sizes.append(min(255, int(math.log(len(s)) / math.log(100 / PERCENT))))
            size += len(held[-1])
            if size >= CHUNK:
                yield flush()
                held, nodes, sizes, size, seen = [], [], [], 0, set()
        if size:
            yield flush()

    def connect(batches):
        for _, (v, x, z) in _runs(batches, "r", ("v", "x", "z")):
            pairs = [np.stack([np.frombuffer(b, "<i8") for b in pair], 1) for *pair, sizes in zip(v, x, z, strict=True) if sizes is None]
            met = [i for i, sizes in enumerate(z) if sizes is not None]
            if met:
                value = np.concatenate([unpack(v[i]) for i in met])
                node = np.concatenate([np.frombuffer(x[i], "<i8") for i in met])
                step = np.concatenate([np.frombuffer(z[i], np.uint8) for i in met])
                order = np.lexsort((step, value))
                value, node, step = value[order], node[order], step[order].astype(np.int16)
                new = np.concatenate([[True], (value[1:] != value[:-1]) | (step[1:] - step[:-1] > 1)])
                centre = np.minimum.reduceat(node, np.flatnonzero(new))[np.cumsum(new) - 1]
                pairs.append(np.stack([node, centre], 1)[node != centre])
            pairs = np.unique(np.concatenate(pairs), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, c]), pa.int64()) for c in (0, 1)], names=["a", "b"])

    packed = docs.select("text").mapInArrow(emit, "r long, v binary, x binary, z binary")
    return packed.repartition("r").sortWithinPartitions("r").mapInArrow(connect, "a long, b long")


# ---------------------------------------------------------------- 3. cells and guests


class Sets:
    """Some sets held together, with distances from one of them to all."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets])
        flat = np.concatenate(sets) if sets else np.zeros(0, _U)
        self.values, self.ids = np.unique(flat, return_inverse=True)
        self.start = np.concatenate([[0], np.cumsum(self.n)[:-1]])
        self.mark = np.zeros(len(self.values), bool)

    def own(self, i: int) -> np.ndarray:
        return self.ids[self.start[i] : self.start[i] + self.n[i]]

    def shared(self, i: int, rows: np.ndarray | None = None) -> np.ndarray:
        """How many elements set i shares with each set (or with those of ``rows``)."""
        self.mark[self.own(i)] = True
        if rows is None:
            out = np.add.reduceat(self.mark[self.ids], self.start, dtype=np.int64)
        else:
            out = np.array([np.count_nonzero(self.mark[self.own(j)]) for j in rows.tolist()])
        self.mark[self.own(i)] = False
        return out


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


def shared_pairs(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right`` (or of ``left``)."""
    sets, n = [*left, *(right or [])], len(left)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, ids, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    again = times > 1
    ids, rows = (np.cumsum(again) - 1)[ids[again[ids]]], rows[again[ids]]
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    width, total = max(1, CELLS // len(sets)), int(again.sum())
    out = np.zeros((n, n if right is None else len(right)), np.int64)
    for low in range(0, total, width):
        a, b = np.searchsorted(ids, [low, low + width])
        part = np.zeros((len(sets), min(width, total - low)), np.float32)
        part[rows[a:b], ids[a:b] - low] = 1
        out += (part[:n] @ (part if right is None else part[n:]).T).astype(np.int64)
    return out


def links_between(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Which sets of ``left`` link with which of ``right`` (or with which others of ``left``)."""
    n_a = np.array([len(s) for s in left])[:, None]
    n_b = n_a.T if right is None else np.array([len(s) for s in right])
    out = linked(shared_pairs(left, right), n_a, n_b)
    if right is None:
        np.fill_diagonal(out, False)
    return out


def cells_of(distance: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot and distance of each column of ``distance`` (pivots by sets); -1: far from all.
    ``turn`` (per set) says at which pivot the search begins, so that ties are spread."""
    n = len(distance)
    order = (np.arange(n)[:, None] + turn) % n
    at = np.take_along_axis(distance, order, 0).argmin(0)
    nearest = np.take_along_axis(order, at[None], 0)[0]
    least = distance[nearest, np.arange(distance.shape[1])]
    return np.where(least <= FAR + EPS, nearest, -1), least


def guest_of(distance: np.ndarray, least: np.ndarray, cell: np.ndarray, guest: np.ndarray) -> np.ndarray:
    """Where each set goes as a guest: pivots by sets, and a last line for the cell of the far ones."""
    near = (distance <= FAR + RADIUS + EPS) & (distance <= least + 2 * RADIUS + EPS)
    # Of two cells' members the later one's are the guests; the far ones' cell is before all.
    near &= guest | (np.arange(len(distance))[:, None] < cell)
    return np.vstack([near, (least > FAR - RADIUS - EPS) & (guest | (cell >= 0))])


def join_sets(sets: list[np.ndarray], natives: int, weight: np.ndarray | None = None, inner: bool = True) -> tuple[list[int], np.ndarray]:
    """The component of each set (the least position in it) by links of the first ``natives`` sets
    with each other (if ``inner``) and with the rest, exactly; with a ``weight`` of each set also
    the weights of all sets it so links with, added up.

    Pivots split the natives into cells, whose guests follow, until few are left to compare.
    """
    parts, links = Union(len(sets)), np.zeros(len(sets), np.int64)
    held = Sets(sets) if natives > FEW else None

    def compare(own: np.ndarray, guests: np.ndarray, inner: bool) -> None:
        for at in range(0, len(own), REGION):
            some = own[at : at + REGION]
            if inner:
                found = links_between([sets[i] for i in some])
                for i, j in zip(*np.nonzero(np.triu(found)), strict=True):
                    parts.join(int(some[i]), int(some[j]))
                if weight is not None:
                    links[some] += found @ weight[some]
            others = np.concatenate([own[at + REGION :], guests]) if inner else guests
            for to in range(0, len(others), REGION):
                more = others[to : to + REGION]
                found = links_between([sets[i] for i in some], [sets[i] for i in more])
                for i, j in zip(*np.nonzero(found), strict=True):
                    parts.join(int(some[i]), int(more[j]))
                if weight is not None:
                    links[some] += found @ weight[more]
                    links[more] += found.T @ weight[some]

    todo = [(np.arange(natives), np.arange(natives, len(sets)), inner)]
    while todo:
        own, guests, inner = todo.pop()
        if not len(own) or not inner and not len(guests):
            continue
        if weight is None and len({parts.find(i) for i in [*own.tolist(), *guests.tolist()]}) == 1:
            continue  # nothing left to learn
        if len(own) <= FEW:
            compare(own, guests, inner)
            continue
        pivots = own[np.linspace(0, len(own) - 1, INNER_PIVOTS).astype(int)]
        both = np.concatenate([own, guests])
        shared = np.stack([held.shared(int(p))[both] for p in pivots])
        distance = 1 - shared / (held.n[pivots][:, None] + held.n[both] - shared)
        if weight is None and inner:
            for p, i in zip(*np.nonzero(linked(shared, held.n[pivots][:, None], held.n[both])), strict=True):
                parts.join(int(pivots[p]), int(both[i]))
        cell, least = cells_of(distance, both % INNER_PIVOTS)
        is_guest = np.arange(len(both)) >= len(own)
        goes = guest_of(distance, least, cell, is_guest)
        if not inner:  # natives of one region were compared elsewhere
            goes &= is_guest
        sizes = [int(((cell == c) & ~is_guest).sum()) for c in range(-1, len(pivots))]
        if max(sizes) == len(own):
            compare(own, guests, inner)
            continue
        todo += [(both[(cell == c) & ~is_guest], both[goes[c]], inner) for c in range(-1, len(pivots))]
    return [parts.find(i) for i in range(len(sets))], links


def _set_of(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u8")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _batches(rows: list[tuple], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes of the last column at most (one row may exceed it alone)."""
    held, size = [], 0
    for row in rows:
        if held and size + len(row[-1] or b"") > most:
            yield _batch(held, schema)
            held, size = [], 0
        held.append(row)
        size += len(row[-1] or b"")
    if held:
        yield _batch(held, schema)


def _name(*of: int) -> int:
    """A 64-bit number for a sequence of them."""
    h = np.zeros(1, _U)
    for x in of:
        h = _mix(h * _U(_BASE) + np.array([x], np.int64).view(_U) + _U(1))
    return int(h.view(np.int64)[0])


def join_regions(members: DataFrame, docs: DataFrame, count: bool = False) -> DataFrame:
    """One pass over the texts of all regions: kind 0 rows (id, comp, links) are done; kind 1 rows
    hand on the sets of regions that are larger than a task takes.

    ``members`` has region, big, k1, k2, weight and a row of the class (doc_id, place); links are
    added up if ``count``.  Repeats of that row are left out.
    """
    found = members.withColumnsRenamed({"doc_id": "_id", "place": "_place"}).join(located(docs).hint("merge"), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_place") == F.col("place")))
    salt = F.when(F.col("big"), F.xxhash64("k1")).otherwise(F.lit(0))
    rows = found.select("region", "big", "k1", "k2", "weight", "text", F.pmod(salt, F.lit(1 << 20)).alias("salt"))
    rows = rows.repartition("region", "salt").sortWithinPartitions("region", "k1", "k2")
    schema = pa.schema([("kind", pa.int32()), ("region", pa.int64()), ("id", pa.int64()), ("comp", pa.int64()), ("weight", pa.int64()), ("links", pa.int64()), ("elements", pa.binary())])

    def run(batches):
        for region, (k1, k2, big, weights, texts) in _runs(batches, "region", ("k1", "k2", "big", "weight", "text"), 2):
            if big[0]:
                for i, w, t in zip(k1, weights, texts, strict=True):
                    yield _batch([(1, region, i, i, w, 0, shingles(t).astype("<u8").tobytes())], schema)
                continue
            sets = [shingles(t) for t in texts]
            parts, links = join_sets(sets, len(sets), np.array(weights) if count else None)
            yield _batch([(0, region, i, k1[p], w, int(x), None) for i, p, w, x in zip(k1, parts, weights, links, strict=True)], schema)

    return rows.mapInArrow(run, "kind int, region long, id long, comp long, weight long, links long, elements binary")


ACTIVE = "region long, guest boolean, id long, tie long, weight long, elements binary"
_ACTIVE = pa.schema([("region", pa.int64()), ("guest", pa.bool_()), ("id", pa.int64()), ("tie", pa.int64()), ("weight", pa.int64()), ("elements", pa.binary())])
_COLUMNS = [f.name for f in _ACTIVE]


def region_sizes(active: DataFrame, per_task: int, count: bool) -> DataFrame:
    """region, lines (blocks of its natives), columns (those and the chunks of its guests), salts
    (tasks that all its sets are dealt over in a round), big, of the regions in which something
    is left to learn."""
    size = F.octet_length("elements") / 8
    of = lambda c, keep: F.coalesce(F.sum(F.when(keep, c)), F.lit(0))
    own = ~F.col("guest")
    sizes = active.groupBy("region").agg(of(F.lit(1), own).alias("natives"), of(size, own).alias("own"), of(F.lit(1), F.col("guest")).alias("guests"), of(size, F.col("guest")).alias("others"), (F.min("tie") < F.max("tie")).alias("open"))
    left = sizes.where((F.col("natives") > 0) & (F.col("natives") + F.col("guests") > 1) & (F.lit(count) | F.col("open")))
    parts = lambda n, e: F.greatest(F.ceil(F.col(n) / per_task), F.ceil(F.col(e) / ELEMENTS)).cast("int")
    lines = F.least(F.col("natives"), parts("natives", "own")).cast("int")
    chunks = F.least(F.col("guests"), parts("guests", "others")).cast("int")
    return left.select("region", lines.alias("lines"), (lines + chunks).alias("columns"), (lines + chunks).alias("salts"), (lines > BLOCKS).alias("big"))


def _dealt(rows: DataFrame, tasks: str, name: str) -> DataFrame:
    """``rows`` over so many parts of their region."""
    return rows.withColumn(name, F.pmod(F.xxhash64("id", F.lit(3)), F.col(tasks)).cast("int"))


def leaf_links(active: DataFrame, sizes: DataFrame, count: bool) -> DataFrame:
    """Links (a, b) of regions of few blocks, b in a's component there, n: the weights of all sets
    that a links with there.

    A task joins a block of natives with itself, with a later block, or with a chunk of guests.
    """
    rows = active.join(sizes.where(~F.col("big")), "region")
    own = _dealt(rows.where(~F.col("guest")), "lines", "block")
    until = lambda low, high: F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    left = own.withColumns({"line": F.col("block"), "second": F.lit(False)}).withColumn("column", F.explode(F.sequence(F.col("block"), F.col("columns") - 1)))
    right = own.withColumns({"column": F.col("block"), "second": F.lit(True)}).withColumn("line", F.explode(until(F.lit(0), F.col("block") - 1)))
    guests = rows.where("guest").withColumn("chunks", F.col("columns") - F.col("lines"))
    guests = _dealt(guests, "chunks", "chunk").withColumns({"column": F.col("lines") + F.col("chunk"), "second": F.lit(True)}).withColumn("line", F.explode(F.sequence(F.lit(0), F.col("lines") - 1)))
    keep = ["region", "line", "column", "second", "id", "weight", "elements"]
    rows = left.select(*keep).unionByName(right.select(*keep)).unionByName(guests.select(*keep))
    rows = rows.repartition("region", "line", "column").sortWithinPartitions("region", "line", "column", "second", "id").select(F.concat_ws(":", "region", "line", "column").alias("key"), "second", "id", "weight", "elements")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for key, (second, ids, weight, blobs) in _runs(batches, "key", ("second", "id", "weight", "elements")):
            natives, (_, line, column) = len(ids) - sum(second), key.rsplit(":", 2)
            parts, links = join_sets([_set_of(b) for b in blobs], natives, np.array(weight) if count else None, line == column)
            yield _batch([(ids[i], ids[p], int(n)) for i, (p, n) in enumerate(zip(parts, links, strict=True)) if p != i or n], schema)

    return rows.mapInArrow(run, "a long, b long, n long")


def pivot_round(active: DataFrame, sizes: DataFrame, turn: int, pivots: int) -> DataFrame:
    """The cells of the large regions as regions of their own, with their guests (``ACTIVE``).

    Pivots are natives picked by hash, as many as fit beside a task's sets; they are copied to
    each of the region's tasks, where they come before the sets.
    """
    rows = active.join(sizes.where("big"), "region")
    draw = Window.partitionBy("region").orderBy(F.xxhash64("id", F.lit(100 + turn)), "id")
    chosen = rows.where(~F.col("guest")).select("region", "id", F.octet_length("elements").alias("bytes")).withColumns({"rank": F.row_number().over(draw)}).where(F.col("rank") <= pivots)
    chosen = chosen.withColumn("upto", F.sum("bytes").over(Window.partitionBy("region").orderBy("rank"))).where((F.col("rank") <= 2) | (F.col("upto") <= 8 * ELEMENTS)).select("region", "id")
    centres = rows.where(~F.col("guest")).join(chosen, ["region", "id"], "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    rows = centres.withColumn("kind", F.lit(0)).unionByName(_dealt(rows, "salts", "salt").withColumn("kind", F.lit(1)))
    rows = rows.repartition("region", "salt").sortWithinPartitions("region", "salt", "kind", "id").select(F.concat_ws(":", "region", "salt").alias("key"), "kind", *_COLUMNS[1:])

    def run(batches):
        for key, (kind, guest, ids, tie, weight, blobs) in _runs(batches, "key", ("kind", "guest", "id", "tie", "weight", "elements")):
            region, n = int(key.split(":")[0]), sum(k == 0 for k in kind)
            sets = [_set_of(b) for b in blobs]
            held, parts = Sets(sets), Union(n)
            shared = np.stack([held.shared(p) for p in range(n)])
            own_n = held.n[:n, None]
            link, distance = linked(shared, own_n, held.n), 1 - shared / (own_n + held.n - shared)
            for p, q in zip(*np.nonzero(link[:, :n]), strict=True):
                parts.join(int(p), int(q))
            distance, link = distance[:, n:], link[:, n:]
            names = [_name(region, turn, ids[p]) for p in range(n)] + [_name(region, turn)]
            is_guest = np.array(guest[n:], bool)
            cell, least = cells_of(distance, (np.array(ids[n:], np.int64).view(_U) % _U(n)).astype(np.int64))
            goes = guest_of(distance, least, cell, is_guest)
            out = []
            for j in range(len(ids) - n):
                reach = np.flatnonzero(link[:, j])
                row = (ids[n + j], ids[parts.find(int(reach[0]))] if len(reach) else tie[n + j], weight[n + j], blobs[n + j])
                if not is_guest[j]:
                    out.append((names[cell[j]], False, *row))
                out += [(names[c], True, *row) for c in np.flatnonzero(goes[:, j])]
                # A row that says which pivots a set links with; pivots say it for themselves.
                out += [(region, None, ids[n + j], ids[int(p)], 0, None) for p in {parts.find(int(p)): int(p) for p in reach}.values() if ids[int(p)] != ids[n + j]]
            if key.endswith(":0"):
                out += [(region, None, ids[p], ids[parts.find(p)], 0, None) for p in range(n) if parts.find(p) != p]
            yield from _batches(out, _ACTIVE)

    return rows.mapInArrow(run, ACTIVE)


def split_again(active: DataFrame, sizes: DataFrame, label: str) -> DataFrame:
    """``active`` with its large regions split by shared first elements, of an order by their counts
    inside the region: much that repeats in the corpus is alone in a region."""
    big = active.join(sizes.where("big").select("region"), "region", "left_semi")

    def run(batches):
        for batch in batches:
            region, ids, blobs = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("region", "id", "elements"))
            for r, i, b in zip(region, ids, blobs, strict=True):
                e = _set_of(b).view(np.int64)
                for at in range(0, len(e), 1 << 16):
                    part = e[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), v), pa.int64()) for v in (r, i, len(e))] + [pa.array(part, pa.int64())], names=["region", "id", "n", "e"])

    listed = big.select("region", "id", "elements").mapInArrow(run, "region long, id long, n long, e long")
    # Elements that a region holds once come first in their set and tie nothing.
    repeated = listed.groupBy("region", "e").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = listed.join(repeated.hint("merge"), ["region", "e"])
    own = Window.partitionBy("region", "id")
    ranked = shared.withColumns({"rank": F.row_number().over(own.orderBy("c", "e")), "m": F.count(F.lit(1)).over(own)})
    need = F.floor((F.col("n") * PERCENT + 99) / 100)
    first = ranked.where(F.col("rank") <= F.col("m") - need + 1)  # n - need + 1 in all, n - m of them alone
    first = through_table(first.select("region", "id", "e"), f"{label}-first")
    node = F.xxhash64("region", "id")
    centre = first.groupBy("region", "e").agg(F.min(node).alias("b"))
    edges = first.join(centre.hint("merge"), ["region", "e"]).select(node.alias("a"), "b")
    roots = components(edges, label).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    moved = big.withColumn("_node", node).join(roots.hint("merge"), "_node").select(F.col("_root").alias("region"), *_COLUMNS[1:])
    drop_table(first)
    return active.join(sizes.where(~F.col("big")).select("region"), "region", "left_semi").unionByName(moved)


def join_large(active: DataFrame, per_task: int = REGION, pivots: int = PIVOTS, count: bool = False) -> DataFrame:
    """id, comp, links of the sets of large regions.  ``active``: region, id, weight, elements."""
    active = active.select("region", F.lit(False).alias("guest"), "id", F.col("id").alias("tie"), "weight", "elements")
    links, turn, spent = None, 0, []

    def kept(df: DataFrame, label: str) -> DataFrame:
        spent.append(through_table(df, label))
        return spent[-1]

    def sized() -> tuple[DataFrame, int, int]:
        sizes = kept(region_sizes(active, per_task, count), "jaccard-sizes")
        state = sizes.agg(F.count(F.when(~F.col("big"), 1)).alias("small"), F.count(F.when(F.col("big"), 1)).alias("big")).first()
        return sizes, state["small"], state["big"]

    while True:
        sizes, small, big = sized()
        if turn and big:
            active = kept(split_again(active, sizes, "jaccard-split"), "jaccard-active")
            sizes, small, big = sized()
        if not small and not big:
            break
        found, after = [], None
        if small:
            found.append(leaf_links(active, sizes, count))
        if big:
            after = through_table(pivot_round(active, sizes, turn, min(MOST_PIVOTS, pivots * 4**turn)), "jaccard-active")
            found.append(after.where("guest is null").select(F.col("id").alias("a"), F.col("tie").alias("b"), F.lit(0).cast("long").alias("n")))
        found = through_table((found[0] if len(found) == 1 else found[0].unionByName(found[1])).groupBy("a", "b").agg(F.sum("n").alias("n")), "jaccard-links")
        links = found if links is None else links.unionByName(found)
        for table in spent:
            drop_table(table)
        spent.clear()
        if after is None:
            break
        spent.append(after)
        active, turn = after.where("guest is not null"), turn + 1
    if links is None:
        return active.select("id", F.col("id").alias("comp"), F.lit(0).cast("long").alias("links"))
    roots = components(links.select("a", "b"), "jaccard-large").select(F.col("node").alias("id"), F.col("root").alias("comp"))
    if not count:
        return roots.withColumn("links", F.lit(0).cast("long"))
    return roots.join(links.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links")).hint("merge"), "id", "left").select("id", "comp", F.coalesce("links", F.lit(0)).alias("links"))


# ---------------------------------------------------------------- 4. and 5. all of it


def _joined(docs: DataFrame, per_task: int, pivots: int, heavy_limit: int, map_bits: int, count: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, place, n, k1, k2), and the classes that link with others: k1, comp, links
    (right only if ``count``) and component_id."""
    bounded_batches(docs.sparkSession)
    keys = through_table(classes_of(docs), "jaccard-keys")
    total = keys.agg(F.sum("n")).first()[0] or 0
    bits = min(24, max(8, math.ceil(math.log2(max(1, total / (1 << 20))))))

    table = element_counts(docs, bits)
    heavy, counts = most_frequent(table, heavy_limit)
    size = max(bits + 3, min(map_bits, max(1, total).bit_length() + 1))
    edges = region_edges(docs, bits, heavy, counts, repeated_map(table, bits, size))
    regions = components(edges, "jaccard-regions").select(F.col("node").alias("k1"), F.col("root").alias("region"))
    drop_table(table)
    first = [F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("place", "doc_id"), F.min("place")).alias("place")]
    classes = keys.where("n > 0").groupBy("n", "k1", "k2").agg(*first, F.count(F.lit(1)).alias("weight"))
    members = through_table(classes.join(regions, "k1").select("region", "n", "doc_id", "place", "k1", "k2", "weight"), "jaccard-members")
    sizes = members.groupBy("region").agg(((F.count(F.lit(1)) > per_task) | (F.sum("n") > ELEMENTS)).alias("big"))
    done = through_table(join_regions(members.join(sizes, "region"), docs, count), "jaccard-done")

    large = join_large(done.where("kind = 1").select("region", "id", "weight", "elements"), per_task, pivots, count)
    tied = "comp <> id or links > 0"
    # The root of a component is tied to itself.
    pairs = done.where("kind = 0").select("id", "comp", "links").unionByName(large)
    roots = pairs.where("comp <> id").select(F.col("comp").alias("id")).distinct().withColumn("root", F.lit(True))
    found = pairs.join(roots.hint("merge"), "id", "left").where(f"root or {tied}").select(F.col("id").alias("k1"), "comp", "links")
    named = through_table(members.select("k1", "doc_id").join(found.hint("merge"), "k1"), "jaccard-named")
    ids = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    return keys, met(named.select("k1", "comp", "links"), ids, "comp", "k1", hub_limit(named.count()))


def _rows(docs: DataFrame, per_task: int, pivots: int, heavy_limit: int, map_bits: int, count: bool) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (right only if ``count``): one row per row of ``docs``."""
    keys, named = _joined(docs, per_task, pivots, heavy_limit, map_bits, count)
    own = keys.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("own_id"), F.count(F.lit(1)).alias("weight"))
    classes = own.join(named.select("k1", "component_id", "links").withColumn("tied", F.lit(True)).hint("merge"), "k1", "left")
    classes = classes.select("n", "k1", "k2", F.when(F.col("tied"), F.col("component_id")).otherwise(F.col("own_id")).alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    joined = keys.join(classes.hint("merge"), ["n", "k1", "k2"], "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_components(docs: DataFrame, per_task: int = REGION, pivots: int = PIVOTS, heavy_limit: int = HEAVY, map_bits: int = MAP_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``."""
    return _rows(docs, per_task, pivots, heavy_limit, map_bits, False).drop("n_links")


def jaccard_links(docs: DataFrame, per_task: int = REGION, pivots: int = PIVOTS, heavy_limit: int = HEAVY, map_bits: int = MAP_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links: one row per row of ``docs``."""
    return _rows(docs, per_task, pivots, heavy_limit, map_bits, True)


def keep_one(docs: DataFrame, per_task: int = REGION, pivots: int = PIVOTS) -> DataFrame:
    """One row of ``docs`` of each component: of those with the smallest doc_id the one with the
    least hash of its text.  Rows with an empty set all stay."""
    keys, named = _joined(docs, per_task, pivots, HEAVY, MAP_BITS, False)
    rows = keys.where("n > 0").join(named.select("k1", "comp").hint("merge"), "k1", "left")
    group = [F.when(F.col("comp").isNull(), F.col(c)).alias(c) for c in ("n", "k1", "k2")]
    firsts = rows.select(F.col("comp"), *group, "doc_id", "place").groupBy("comp", "n", "k1", "k2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")).alias("f"))
    empty = keys.where("n = 0").select("doc_id", "place", F.lit(True).alias("all")).distinct()
    id_, place, every, at, nth = (spare(docs, n) for n in ("_id", "_place", "_all", "_at", "_nth"))
    kept = firsts.select("f.doc_id", "f.place", F.lit(False).alias("all")).unionByName(empty).select(F.col("doc_id").alias(id_), F.col("place").alias(place), F.col("all").alias(every))
    kept = through_table(kept, "jaccard-kept")
    marked = docs.withColumn(at, F.xxhash64(F.coalesce("text", F.lit("")), F.lit(5)))
    met = marked.join(kept.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(at) == F.col(place)))
    # Repeats of the row that stays go; rows that link with nothing stay all.
    return met.withColumn(nth, F.row_number().over(Window.partitionBy(id_, place).orderBy(F.lit(0)))).where(F.col(every) | (F.col(nth) == 1)).select(*docs.columns)
