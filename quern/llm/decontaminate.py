"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are reduced to their letters and digits, lower-cased.  An item of m
characters that occurs in a text with at most e edits shares at least m - q + 1 - q*e of its
q-grams with the place, and their diagonals (text position minus item position) differ by at
most e.  The q-grams of a text are looked up in the item index, hits are counted in overlapping
bands of diagonals, and bands that reach the item's bound are verified by an alignment confined
to the band.  The lemma loses no occurrence within the budget; the alignment admits no other.

The item index is what tasks carry.  Its size is checked: beyond ``SLICE_CHARS`` the benchmark
is dealt into slices, held one at a time, and the documents are read once for each.

Defined results
    null and empty texts contain nothing; items without any letter or digit match nothing;
    items with fewer than ``Q`` of them have no q-gram and match as whole words, without edits,
    whatever stands between the words; items with equal text all match; of several places of an
    item the one with the fewest edits is given, of equal ones the first; an empty benchmark leaves
    every document clean; an empty table gives an empty result; repeated rows get equal results;
    very long texts are read whole, also where one q-gram fills them; further columns, whatever
    their names, are not read by ``find_leaks`` and passed on by ``drop_leaks``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, codepoints, through_table

Q = 10
#: Edits allowed, as a share of an item's length.
EDIT_SHARE = 0.08
#: Characters of benchmark text that one index holds.
SLICE_CHARS = 2_000_000
TABLE_BITS = 20
#: Hits, places and cells of alignments that one text has open at once.
OPEN_HITS, OPEN_PLACES, OPEN_CELLS = 1 << 20, 1 << 14, 1 << 17
_P = np.uint64(0x9E3779B97F4A7C15)

_ALNUM: list[np.ndarray] = []


def letters(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased letters and digits of a text, and their places in it."""
    if not _ALNUM:
        _ALNUM.append(np.array([chr(c).isalnum() for c in range(0x110000)], bool))
    low = text.lower()
    if len(low) != len(text):  # a few letters grow when lower-cased; keep places true
        low = "".join(c.lower()[:1] for c in text)
    cp = codepoints(low)
    at = np.flatnonzero(_ALNUM[0][cp])
    return cp[at], at


def words_of(cp: np.ndarray, at: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The words of what ``letters`` gives, and where each begins in it (and the end)."""
    start = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1])) if len(at) else np.zeros(0, np.int64)
    start = np.append(start, len(cp))
    whole = cp.astype("<u4").tobytes().decode("utf-32-le")
    return [whole[a:b] for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)], start


def _power(k: int) -> np.uint64:
    return np.uint64(pow(int(_P), k, 1 << 64))


def qgram_hashes(cp: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each q-gram, built by doubling."""
    if len(cp) < q:
        return np.zeros(0, np.uint64)
    power_of_two = [cp.astype(np.uint64) + np.uint64(1)]
    size = 1
    while size * 2 <= q:
        h = power_of_two[-1]
        power_of_two.append(h[:-size] + h[size:] * _power(size))
        size *= 2
    out, done = power_of_two[-1], size
    while done < q:
        size = 1 << (int(math.log2(q - done)))
        part = power_of_two[int(math.log2(size))]
        n = len(cp) - done - size + 1
        out = out[:n] + part[done : done + n] * _power(done)
        done += size
    return out ^ (out >> np.uint64(29))


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Item:
    item_id: int
    text: str
    cp: np.ndarray
    edits: int
    least: int


class Index:
    """The q-grams of some items: a table of bits before a sorted list of (hash, item, run of places)."""

    def __init__(self, rows: list[tuple[int, str]], edit_share: float = EDIT_SHARE, q: int = Q):
        self.q = q
        self.items: list[Item] = []
        #: Items without a q-gram, by their words.
        self.short: dict[tuple[str, ...], list[int]] = {}
        hashes, owners, places = [], [], []
        for item_id, text in rows:
            cp, at = letters(text or "")
            m = len(cp)
            if m < q:
                if m:
                    self.short.setdefault(tuple(words_of(cp, at)[0]), []).append(item_id)
                continue
            edits = min(int(edit_share * m), (m - q) // q)
            h = qgram_hashes(cp, q)
            hashes.append(h)
            owners.append(np.full(len(h), len(self.items)))
            places.append(np.arange(len(h)))
            self.items.append(Item(item_id, cp.tobytes().decode("utf-32-le"), cp, edits, m - q + 1 - q * edits))
        self.bits = np.zeros(1 << TABLE_BITS, bool)
        if not self.items:
            return
        self.width = np.array([i.edits + 1 for i in self.items])
        self.least = np.array([i.least for i in self.items])
        self.longest = max(len(i.cp) for i in self.items)
        h, owner, place = np.concatenate(hashes), np.concatenate(owners), np.concatenate(places)
        order = np.lexsort((place, owner, h))
        h, owner, place = h[order], owner[order], place[order]
        # A run: neighbouring places of an item with one q-gram.
        begin = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)])
        at = np.flatnonzero(begin)
        self.owner, self.first, self.last = owner[at], place[at], place[np.append(at[1:], len(h)) - 1]
        self.hash, self.start = np.unique(h[at], return_index=True)
        self.start = np.append(self.start, len(at))
        #: Bands that the runs of a q-gram reach at one place, at most.
        self.reach = np.add.reduceat((self.last - self.first) // self.width[self.owner] + 3, self.start[:-1])
        self.fewest = int(self.least.min())
        self.bits[_slot(self.hash)] = True

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, edits) of each item found, at its best place."""
        if not self.items and not self.short:
            return []
        cp, at = letters(text)
        return self._find_long(text, cp, at) + self._find_short(cp, at)

    def _find_short(self, cp: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        if not self.short or not len(cp):
            return []
        words, start = words_of(cp, at)
        first: dict[tuple[str, ...], int] = {}
        for n in {len(key) for key in self.short}:
            for i in range(len(words) - n + 1):
                key = tuple(words[i : i + n])
                if key in self.short:
                    first.setdefault(key, i)
        return [(item_id, int(at[start[i]]), int(at[start[i + len(key)] - 1]) + 1, 0) for key, i in first.items() for item_id in self.short[key]]

    def _candidates(self, h: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(item, bands): the bands of diagonals of each item that hold its least number of hits.

        A text's q-grams are looked up block by block, so that few hits are open at once however
        often a q-gram repeats in the text and in the items.  A place of the text counts once in
        a band: an occurrence keeps its q-grams at different places of the text.
        """
        where = np.flatnonzero(self.bits[_slot(h)])
        if len(where) < self.fewest:
            return []
        near = np.searchsorted(self.hash, h[where])
        near[near == len(self.hash)] = 0
        true = self.hash[near] == h[where]
        where, near = where[true], near[true]
        if len(where) < self.fewest:
            return []
        n = self.start[near + 1] - self.start[near]
        span = (len(h) + self.longest) // int(self.width.min()) + 2
        # Runs are dealt out so that few bands are open at once.
        upto = np.cumsum(self.reach[near])
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = 0
        while at < len(where):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + OPEN_HITS, "right")))
            end = min(end, at + OPEN_PLACES)
            m = n[at:end]
            run = np.repeat(self.start[near[at:end]] - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(m.sum())
            place, nth = np.repeat(where[at:end], m), np.repeat(np.arange(end - at), m)
            owner = self.owner[run]
            # A band overlaps the next, so the one before the first gets the hit too.
            low = np.maximum((place - self.last[run] + self.longest) // self.width[owner] - 1, 0)
            many = (place - self.first[run] + self.longest) // self.width[owner] - low + 1
            band = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            hits = (np.repeat(owner, many) * span + band) * np.int64(end - at) + np.repeat(nth, many)
            found, times = np.unique((np.unique(hits) if len(hits) > end - at else hits) // np.int64(end - at), return_counts=True)
            keys, slot = np.unique(np.concatenate([keys, found]), return_inverse=True)
            counts = np.bincount(slot, np.concatenate([counts, times]), len(keys)).astype(np.int64)
            at = end
        keys = keys[counts >= self.least[keys // span]]
        items = keys // span
        return [(int(k), keys[items == k] - k * span) for k in np.unique(items)]

    def _find_long(self, text: str, cp: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        if not self.items or len(text) < self.q:
            return []
        out, whole = [], None
        for k, bands in self._candidates(qgram_hashes(cp, self.q)):
            item, width = self.items[k], int(self.width[k])
            if whole is None:
                whole = cp.tobytes().decode("utf-32-le")
            hit = whole.find(item.text)
            got = (hit, hit + len(item.cp), 0) if hit >= 0 else align(item.cp, cp, bands * width - self.longest, 2 * width, item.edits)
            if got:
                out.append((item.item_id, int(at[got[0]]), int(at[got[1] - 1]) + 1, got[2]))
        return out


def align(item: np.ndarray, text: np.ndarray, lows: np.ndarray, size: int, budget: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best alignment of the whole item inside one of the bands of
    diagonals [low, low + size); of equal ones that of the first band; None if over budget.

    Row by row over the item, many bands at once; column k stands for text place row + low + k.
    Each cell also carries the diagonal on which its path began.
    """
    best, step = None, max(1, OPEN_CELLS // size)
    for at in range(0, len(lows), step):
        got = _align_bands(item, text, lows[at : at + step, None], size, budget)
        if got and (best is None or got[2] < best[2]):
            best = got
    return best


def _align_bands(item: np.ndarray, text: np.ndarray, low: np.ndarray, size: int, budget: int) -> tuple[int, int, int] | None:
    far = len(item) + budget + 1
    columns = np.arange(size)
    cost = np.where((columns + low >= 0) & (columns + low <= len(text)), 0, far)
    origin = np.broadcast_to(columns, cost.shape)
    outside = np.full((len(low), 1), far)
    for i, c in enumerate(item.tolist()):
        j = i + low + columns
        inside = (j >= 0) & (j < len(text))
        same = inside & (text[np.clip(j, 0, len(text) - 1)] == c)
        step = np.where(inside, cost + ~same, far)
        up = np.concatenate([cost[:, 1:] + 1, outside], 1)
        use_up = up < step
        step = np.where(use_up, up, step)
        start = np.where(use_up, np.concatenate([origin[:, 1:], np.zeros_like(outside)], 1), origin)
        # From the left: one edit a column, so the best is a running minimum of cost - column.
        run = np.minimum.accumulate((step - columns) * (4 * size) + columns, 1)
        cost = run // (4 * size) + columns
        origin = np.take_along_axis(start, run % (4 * size), 1)
        alive = cost.min(1) <= budget
        if not alive.all():
            if not alive.any():
                return None
            cost, origin, low, outside = cost[alive], origin[alive], low[alive], outside[alive]
    band, k = np.unravel_index(int(np.argmin(cost)), cost.shape)
    begin = max(0, int(origin[band, k]) + int(low[band, 0]))
    end = min(len(text), len(item) + int(low[band, 0]) + int(k))
    return (begin, end, int(cost[band, k])) if cost[band, k] <= budget and end > begin else None


SPAN = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
_DDL = "spans array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"


def slices(benchmark: DataFrame, limit: int = SLICE_CHARS) -> Iterator[Index]:
    """Indexes over the benchmark, one after the other, each within ``limit`` characters (one item
    may exceed it alone); the items are streamed, so one slice is held at a time."""
    rows, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).orderBy("item_id", "text").toLocalIterator():
        if rows and size + len(r.text) > limit:
            yield Index(rows)
            rows, size = [], 0
        rows.append((r.item_id if r.item_id is not None else -1, r.text))
        size += len(r.text)
    if rows:
        yield Index(rows)


def _scan(frame: DataFrame, index: Index, with_text: bool) -> DataFrame:
    """Add what ``index`` finds to the spans of ``frame`` (doc_id, text, spans)."""

    def run(batches):
        for batch in batches:
            ids, texts, spans = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text", "spans"))
            found = [[{"item_id": i, "start": s, "end": e, "edits": d} for i, s, e, d in index.find(t or "")] for t in texts.to_pylist()]
            both = pa.array([a + b for a, b in zip(spans.to_pylist(), found, strict=True)], pa.list_(SPAN))
            columns = {"doc_id": ids, "text": texts, "spans": both} if with_text else {"doc_id": ids, "spans": both}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, {'text string, ' * with_text}{_DDL}")


def find_leaks(docs: DataFrame, benchmark: DataFrame, limit: int = SLICE_CHARS) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids, spans: one row per row of ``docs``.

    A benchmark of several slices costs a reading for each; between two the documents go through
    a table, so that plan and driver hold one index only.
    """
    bounded_batches(docs.sparkSession)
    out = docs.select("doc_id", "text", F.array().cast(_DDL.split(" ", 1)[1]).alias("spans"))
    held = None
    for index in slices(benchmark, limit):
        if held is not None:
            out = through_table(_scan(out, held, True), "leaks")
        held = index
    out = _scan(out, held or Index([]), False)
    ids = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    return out.select("doc_id", (F.size("spans") > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), "spans")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, limit: int = SLICE_CHARS) -> DataFrame:
    """The rows of ``docs`` with their columns, without those that contain a benchmark item."""
    bounded_batches(docs.sparkSession)
    schema = docs.schema
    for at, index in enumerate(slices(benchmark, limit)):

        def run(batches, index=index):
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([not index.find(t or "") for t in texts], pa.bool_()))

        docs = (through_table(docs, "leaks") if at else docs).mapInArrow(run, schema)
    return docs
