"""Corpus passes: gates, exact and paragraph deduplication, audit, overlap, faithfulness."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import counting
from quern.functions import text as T
from quern.session import ship, small_batches, through_table


def is_quality(col: Column, min_chars: int = 200, min_alpha: float = 0.5) -> Column:
    """Long enough, and letters make more than ``min_alpha`` of what is not white space."""
    solid = T.solid(col)
    return (F.length(col) >= min_chars) & (solid > 0) & (T.letters(col) > solid * min_alpha)


def publishable(records: DataFrame) -> DataFrame:
    return records.where(F.col("publishable"))


def first_copies(rows: DataFrame, key: str) -> DataFrame:
    """Of the rows of each ``key`` the one that comes first, by one aggregation over the rows as
    they are: for narrow rows, such as a digest with counters."""
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*columns), "ord").alias("_first")).select("_first.*", key)


def exact_dedup(records: DataFrame) -> DataFrame:
    """The first record (by ``ord``, which is unique) of each normal form.

    Digests find the first records; texts are moved once, to meet their ids.
    """
    first = first_copies(records.select("ord", F.sha1(T.norm(T.filled("text"))).alias("_h")), "_h").select("ord")
    return records.join(first, "ord", "left_semi")


def paragraph_frequency(records: DataFrame, sep: str = "\n\n", min_chars: int = 80) -> DataFrame:
    """key, docs: in how many records each long paragraph's normal form occurs."""
    para = records.select("ord", F.explode(F.split(T.filled("text"), sep)).alias("p")).where(F.length(T.strip(F.col("p"))) >= min_chars)
    return para.select("ord", T.norm(F.col("p")).alias("key")).distinct().groupBy("key").agg(F.count(F.lit(1)).alias("docs"))


def paragraph_dedup(records: DataFrame, max_docs: int = 3, min_chars: int = 80, sep: str = "\n\n") -> DataFrame:
    """Remove long paragraphs that occur in more than ``max_docs`` records, everywhere; drop
    records that this leaves empty.

    Paragraphs are told by digests, so the counting moves no text; a record learns the places of
    its own common paragraphs, and only records that have some are put together anew.
    """
    para = records.select("ord", F.posexplode(F.split(T.filled("text"), sep)).alias("pos", "p")).where(F.length(T.strip(F.col("p"))) >= min_chars)
    keyed = through_table(para.select("ord", "pos", F.unhex(F.md5(T.norm(F.col("p")))).alias("key")))
    often = keyed.select("ord", "key").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > max_docs).select("key")
    places = keyed.join(often, "key", "left_semi").groupBy("ord").agg(F.collect_set("pos").alias("_gone"))
    text, gone = T.filled("text"), F.col("_gone")
    rest = F.array_join(F.filter(F.split(text, sep), lambda _, i: ~F.array_contains(gone, i)), sep)
    out = records.join(places, "ord", "left").withColumn("text", T.strip(F.when(gone.isNull(), text).otherwise(rest)))
    return out.drop("_gone").where("text <> ''")


def strip_running_lines(pages: DataFrame, min_pages: int = 4, share: float = 0.5) -> DataFrame:
    """ord, text from (ord, page, text): lines on more than ``share`` of the pages go."""
    texts = pages.groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("pages"))
    lines = F.flatten(F.transform("pages", lambda p: F.transform(F.split(F.coalesce(p["text"], F.lit("\n")), "\n"), lambda x: F.struct(p["page"].cast("long").alias("page"), F.when(p["text"].isNotNull(), x).alias("line")))))
    return without_running_lines(texts.select("ord", F.size("pages").cast("long").alias("pages"), lines.alias("lines")), min_pages, share)


def without_running_lines(texts: DataFrame, min_pages: int = 4, share: float = 0.5) -> DataFrame:
    """ord, text from (ord, pages, lines): a text's lines in order, each (page, line), and the
    number of its pages.  A text is one row throughout, so no task holds more than a few of them.
    Lines that are null are no lines; a text without any line left has no row."""
    ship(texts.sparkSession)
    small_batches(texts.sparkSession)

    def rest(pages: int, lines: list[str | None], at: list[int], keys: list[str | None]) -> str | None:
        seen = Counter(key for key, _ in {(k, p) for k, p in zip(keys, at, strict=True) if k})
        gone = {k for k, n in seen.items() if n > pages * share} if pages >= min_pages else ()
        kept = [x for x, k in zip(lines, keys, strict=True) if x is not None and k not in gone]
        return "\n".join(kept) if kept else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [rest(*row) for row in zip(*(b.column(i).to_pylist() for i in range(1, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["ord", "text"])

    part = texts.select("ord", "pages", F.col("lines.line").alias("line"), F.col("lines.page").alias("page"), F.transform("lines.line", T.line_key).alias("key"))
    return part.mapInArrow(run, f"ord {texts.schema['ord'].dataType.simpleString()}, text string").where("text is not null")


def by_row(rows: DataFrame, texts: list[str], count: Callable[..., tuple], names: tuple[str, ...], ddl: str) -> DataFrame:
    """ord and what ``count`` gives for each row's texts, by Arrow batches."""
    ship(rows.sparkSession)
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(i + 1).to_pylist() for i in range(len(texts))]
            got = [count(*row) for row in zip(*values, strict=True)]
            if got:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(column) for column in zip(*got, strict=True))], names=["ord", *names])

    out = rows.select("ord", *(T.filled(t).alias(t) for t in texts))
    kind = out.schema["ord"].dataType.simpleString()
    return out.mapInArrow(run, f"ord {kind}, {ddl}")


def audit_counters(records: DataFrame) -> DataFrame:
    """Whole-number counters from which the audit's rates and verdict follow."""
    return by_row(records, ["text"], counting.audit_counts, counting.AUDIT, ", ".join(f"{n} long" for n in counting.AUDIT))


def audit(records: DataFrame) -> DataFrame:
    """The counters with rates and a verdict; the verdict is decided on unrounded rates."""
    return rated(audit_counters(records))


def rated(c: DataFrame, prefix: str = "") -> DataFrame:
    """Audit counters with rates and a verdict; names begin with ``prefix``."""
    of = lambda n: F.col(prefix + n)
    per = lambda a, b, empty: F.when(of(b) > 0, of(a) / of(b)).otherwise(F.lit(empty))
    rates = {
        "wordlike_frac": F.when(of("n_cores") > 0, of("n_wordlike") / of("n_cores")).otherwise(F.when(of("n_tokens") == 0, 1.0).otherwise(0.0)),
        "internal_caps_rate": per("n_caps", "n_cores", 0.0),
        "alpha_ratio": per("n_letters", "n_solid", 0.0),
        "long_token_frac": per("n_long", "n_tokens", 0.0),
        "garbage_line_frac": per("n_garbage", "n_lines", 0.0),
        "words_per_line": F.when(of("n_lines") > 0, of("n_tokens") / of("n_lines")).otherwise(of("n_tokens").cast("double")),
    }
    c = c.withColumns({prefix + n: rate for n, rate in rates.items()})
    dense = of("n_tokens") > 200
    bad = (of("wordlike_frac") < 0.60) | (of("internal_caps_rate") > 0.15) | (of("alpha_ratio") < 0.30) | (dense & (of("words_per_line") < 2))
    warn = (of("wordlike_frac") < 0.80) | (of("internal_caps_rate") > 0.06) | (of("long_token_frac") > 0.02) | (of("garbage_line_frac") > 0.50) | (dense & (of("words_per_line") < 4))
    return c.withColumn(prefix + "verdict", F.when(bad, "BAD").when(warn, "WARN").otherwise("OK"))


def worst_first(audited: DataFrame) -> DataFrame:
    rank = F.when(F.col("verdict") == "BAD", 0).when(F.col("verdict") == "WARN", 1).otherwise(2)
    return audited.orderBy(rank, F.desc(F.round("internal_caps_rate", 4)), "ord")


#: Characters of text a part of the shingles stands for, and hashes that a task sends at once.
PART_CHARS, SENT = 12_000_000, 1 << 20
#: Pairs that a task makes at once.
PAIRS = 1 << 18


def _packed(x: np.ndarray) -> bytes:
    """Numbers with their first bytes together, so that what they have in common packs well."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _unpacked(data: list[bytes], kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(d, np.uint8).reshape(size, -1).T).view(kind).ravel() for d in data]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of a sorted array begin, and their lengths."""
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return start, np.diff(np.append(start, len(h)))


def _dealt(h: np.ndarray, ord_: np.ndarray, n: np.ndarray, parts: int, max_docs: int) -> pa.RecordBatch:
    """Rows (part, h, ord, n) of one lot of hashes.  A hash goes ``max_docs`` + 1 times at most:
    that many already say that it is in too many records."""
    order = np.argsort(h, kind="stable")
    h = h[order]
    start, df = _places(h)
    kept = np.arange(len(h)) - np.repeat(start, df) <= max_docs
    h, order = h[kept], order[kept]
    part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    start, size = _places(part)
    cut = lambda x: [_packed(x[s : s + m]) for s, m in zip(start, size, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[start].astype(np.int32)), *(pa.array(cut(np.ascontiguousarray(x)), pa.binary()) for x in (h, ord_[order], n[order]))], names=["part", "h", "ord", "n"]
    )


def _met(h: np.ndarray, ord_: np.ndarray, n: np.ndarray, max_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, na, nb): two records for each hash of 2 to ``max_docs`` records that they share."""
    order = np.argsort(h, kind="stable")
    ord_, n = ord_[order], n[order]
    start, df = _places(h[order])
    for d in np.unique(df[(df >= 2) & (df <= max_docs)]):
        x, y = np.triu_indices(d, 1)
        lists = start[df == d]
        step = max(1, PAIRS // len(x))
        for at in range(0, len(lists), step):
            i, j = ((lists[at : at + step, None] + e).ravel() for e in (x, y))
            i, j = np.where(ord_[i] <= ord_[j], i, j), np.where(ord_[i] <= ord_[j], j, i)
            true = ord_[i] < ord_[j]
            i, j = i[true], j[true]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ord_[i], ord_[j], n[i], n[j])], names=["a", "b", "na", "nb"])


def overlap_pairs(records: DataFrame, threshold: float = 0.75, k: int = 5, max_docs: int = 50) -> DataFrame:
    """a, b, shared, overlap, jaccard of records that share shingles.

    Shingles in more than ``max_docs`` records are left out of ``shared`` (they say little) but
    count in the sizes.  The cap is this report's definition; counts come before any pairing,
    so no list longer than it is built.

    Hashes are moved once, packed, with the records that hold them: to parts of the range of
    hashes, as many as the text asks for, so a task holds the same at any size of the corpus.  A
    part has all records of its hashes, so it counts them and pairs their records in place.
    """
    spark = records.sparkSession
    ship(spark)
    small_batches(spark)
    chars = records.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-chars // PART_CHARS))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ords, count = [], [], 0

        def lot() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in held])
            return _dealt(np.concatenate(held), np.repeat(np.array(ords, np.int64), sizes), np.repeat(sizes.astype(np.int32), sizes), parts, max_docs)

        for b in batches:
            for at, norm in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = counting.shingle_hashes(norm.as_py(), k)
                if not len(own):
                    continue
                held.append(own)
                ords.append(at)
                count += len(own)
                if count >= SENT:
                    yield lot()
                    held, ords, count = [], [], 0
        if held:
            yield lot()

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[bytes]] = [[], [], []]
        for b in batches:
            for c, values in zip(columns, (b.column("h"), b.column("ord"), b.column("n")), strict=True):
                c += values.to_pylist()
        h, ord_, n = (_unpacked(c, t) for c, t in zip(columns, (np.uint64, np.int64, np.int32), strict=True))
        columns.clear()
        yield from _met(h, ord_, n, max_docs)

    normal = records.select(F.col("ord").cast("long").alias("ord"), T.norm(T.filled("text")).alias("norm"))
    rows = normal.mapInArrow(hashed, "part int, h binary, ord binary, n binary").repartitionById(parts, "part")
    met = rows.mapInArrow(paired, "a long, b long, na int, nb int")
    small, shared = F.least("na", "nb"), F.col("shared")
    pairs = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.first("na").cast("long").alias("na"), F.first("nb").cast("long").alias("nb"))
    out = pairs.where(shared >= small * threshold)
    return out.select("a", "b", "shared", (shared / small).alias("overlap"), (shared / (F.col("na") + F.col("nb") - shared)).alias("jaccard"))


COMPARED = ("inter", "n_old", "n_new", "numbers_kept", "old_chars", "new_chars")
COMPARED_DDL = "inter long, n_old long, n_new long, numbers_kept boolean, old_chars long, new_chars long"


def compared(old: str, new: str) -> tuple:
    """What ``is_faithful`` asks for, named by ``COMPARED``."""
    return (*counting.shared_grams(old, new), counting.numbers_kept(old, new), len(old), len(new))


def is_faithful() -> Column:
    return (F.col("n_new") > 0) & (F.col("n_old") > 0) & (F.col("inter") >= F.col("n_new") * 0.80) & (F.col("inter") >= F.col("n_old") * 0.60) & F.col("numbers_kept") & (F.col("new_chars") >= F.col("old_chars") * 0.5)


def faithfulness(pairs: DataFrame) -> DataFrame:
    """ord, inter, n_old, n_new, numbers_kept, faithful from (ord, old, new)."""
    p = by_row(pairs, ["old", "new"], compared, COMPARED, COMPARED_DDL)
    return p.select("ord", "inter", "n_old", "n_new", "numbers_kept", is_faithful().alias("faithful"))


def first_by_hash(records: DataFrame, by: str, k: int, seed: int) -> DataFrame:
    """Up to ``k`` records of each ``by``, in the order of a hash: a repeatable uniform sample.
    The rank limit is applied in every task before the shuffle."""
    w = Window.partitionBy(by).orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col("ord"))), "ord")
    return records.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def build_corpus(records: DataFrame, sep: str = "\n\n") -> DataFrame:
    """Gate, exact copies, common paragraphs, near copies; ``id`` is the sha1 of the final text.

    The texts are used several times by the pass behind, so they go through a table twice."""
    from quern.operators import neardup

    unique = through_table(exact_dedup(records.where(is_quality(T.filled("text")))), "unique")
    return neardup.minhash_dedup(through_table(paragraph_dedup(unique, sep=sep), "paragraphs")).withColumn("id", F.sha1("text"))
