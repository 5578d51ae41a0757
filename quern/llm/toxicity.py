"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton over folded text.

Folding lower-cases, strips accents, maps look-alike letters of other scripts and digits or
symbols used as letters to plain ones, and leaves words apart by single blanks.  Lexicon
entries are whole words and word beginnings, each with a weight; exception phrases are pairs
of neighbouring words in which a match does not count.  The score is the logistic of the sum of
the weights found, divided by a slowly growing function of the length, against a threshold.

The lexicon is learned from labelled documents: entries whose document frequencies differ
between the classes beyond chance (likelihood ratio), weighted by their log odds; exceptions
are the contexts in which entries occur in harmless documents; the threshold separates the
classes best.  The fit uses a bounded sample of labelled rows and reads their texts whole.

Defined results
    null and empty texts contain no entry and score like any text without one; without labels
    of both classes nothing is learned and every score is the share of label 1 (0.0 if none);
    an empty table gives an empty result; repeated rows get equal scores; a score of exactly one
    half counts as toxic; of several labels of
    one id the largest counts, of several texts of one labelled id the first speaks; of several
    entries that match one word the greatest weight counts; very long texts are folded piece by
    piece and read whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, codepoints, fold, labelled_docs, map_texts, sigmoid

#: Labelled rows of each class that the fit uses, at most about.
PER_CLASS = 3000
#: Lengths of the word beginnings tried, and the likelihood ratio that an entry has to reach.
PREFIXES, LEAST_RATIO, LEAST_ODDS = (4, 5, 6), 16.0, 2.0
#: Code points folded at once in one document.
PIECE = 1 << 21

# Look-alike letters, and digits and symbols used as letters.
LOOKALIKES = dict(zip("аеорсхуіјѕһԁԛԝкмнтвαοιυνρτκ", "aeopcxyijshdqwkmhtbaoiuvptk", strict=True))
DIGITS = dict(zip("01345789", "oieastbg", strict=True))
SYMBOLS = {"@": "a", "$": "s", "!": "i", "€": "e"}

_TABLE: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Each lower-case code point's folded code point; 32 for what is not part of a word; symbols as themselves."""
    if not _TABLE:
        table = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x3000):
            ch = chr(c)
            plain = unicodedata.normalize("NFKD", ch)[:1] or ch
            table[c] = ord(plain) if ch.isalnum() and plain.isalnum() else c if ch.isalnum() else 32
        for c in range(0xFF01, 0xFF5F):  # full-width forms
            ch = chr(c - 0xFEE0).lower()
            table[c] = ord(ch) if ch.isalnum() else 32
        table[0x2000:0x2070] = 32
        table[0x3000:0x3004] = 32
        for ch, to in {**LOOKALIKES, **DIGITS}.items():
            table[ord(ch)] = ord(to)
        for ch in SYMBOLS:
            table[ord(ch)] = ord(ch)
        _TABLE.append(table)
    return _TABLE[0]


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about ``PIECE`` code points, cut behind a blank where there is one."""
    at = 0
    while at < len(text):
        end = at + PIECE
        cut = text.rfind(" ", at, end) + 1 if end < len(text) else len(text)
        yield text[at : cut or end]
        at = cut or end


def _folded(text: str) -> str:
    cp = _table()[codepoints(text.lower())]
    for ch, to in SYMBOLS.items():
        at = np.flatnonzero(cp == ord(ch))
        if len(at):
            before = np.where(at > 0, cp[np.maximum(at - 1, 0)], 32)
            after = np.where(at + 1 < len(cp), cp[np.minimum(at + 1, len(cp) - 1)], 32)
            inside = (before > 96) & (after > 96)
            cp[at] = np.where(inside, ord(to), 32)
    return cp.astype("<u4").tobytes().decode("utf-32-le")


def fold_text(text: str) -> str:
    """Folded text with a blank at both ends.  A symbol counts as a letter only between letters."""
    return " " + "".join(map(_folded, pieces(text))) + " "


def word_features(word: str) -> list[str]:
    """The entries a word could match: itself (blank at both ends) and its beginnings."""
    return [f" {word} ", *(f" {word[:k]}" for k in PREFIXES if len(word) > k)]


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: frozenset[tuple[str, str]] = frozenset()
    threshold: float = 1.0
    base: float = 0.0
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._automaton.add_word(entry, (len(entry), weight))
            self._automaton.make_automaton()
        return self._automaton

    def matches(self, folded: str) -> dict[int, tuple[str, float]]:
        """For each word (by its start) that some entry matches: the word and its greatest weight."""
        found: dict[int, tuple[str, float]] = {}
        if not self.weights:
            return found
        for end, (size, weight) in self.automaton().iter(folded):
            start = end - size + 2
            if start not in found or weight > found[start][1]:
                word = found[start][0] if start in found else folded[start : folded.index(" ", start)]
                found[start] = (word, weight)
        return found

    def contexts(self, folded: str, start: int, word: str) -> list[tuple[str, str]]:
        """The word with the one before it, and with the one after it (empty at the ends)."""
        last = start - 1
        while last >= 0 and folded[last] == " ":
            last -= 1
        before = folded[folded.rfind(" ", 0, last + 1) + 1 : last + 1]
        first = start + len(word)
        while first < len(folded) and folded[first] == " ":
            first += 1
        after = folded[first : folded.find(" ", first)] if first < len(folded) else ""
        return [(before, word), (word, after)]

    def measure(self, text: str) -> float:
        """Weights found, normalised by length."""
        folded = fold_text(text)
        total = 0.0
        for start, (word, weight) in self.matches(folded).items():
            if not self.exceptions or not self.exceptions.intersection(self.contexts(folded, start, word)):
                total += weight
        return total / length_norm(folded.count(" "))

    def score(self, text: str) -> float:
        if not self.weights:
            return self.base
        return sigmoid(4.0 * (self.measure(text) / self.threshold - 1.0))


def length_norm(words: int) -> float:
    """One up to 100 words, then growing with the logarithm."""
    return 1.0 + math.log10(max(words, 100) / 100)


def _ratio(a: int, na: int, b: int, nb: int) -> float:
    """Twice the log likelihood ratio of two shares being different."""

    def part(k: int, n: int, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n - k else 0.0)

    pooled = (a + b) / (na + nb)
    return 2 * (part(a, na, a / na) + part(b, nb, b / nb) - part(a, na, pooled) - part(b, nb, pooled)) if 0 < pooled < 1 else 0.0


def _counting(rows: DataFrame, features, name: str) -> DataFrame:
    """How many rows have each feature: combined per task before the shuffle."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(features(text))
        keys = list(counts)
        for at in range(0, len(keys), 20_000):
            part = keys[at : at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[k] for k in part], pa.int64())], names=["f", "n"])

    return rows.select("text").mapInArrow(run, "f string, n long").groupBy("f").agg(F.sum("n").alias(name))


def _paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """f, n, m: the counts n of ``left`` with those of ``right`` beside them."""
    return left.join(right.hint("merge"), "f", "left").select("f", "n", F.coalesce("m", F.lit(0)).cast("long").alias("m"))


def _where(pairs: DataFrame, test) -> DataFrame:
    """The rows of ``_paired`` whose counts pass ``test``."""

    def run(batches):
        for batch in batches:
            n, m = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in "nm")
            yield batch.filter(pa.array([test(a, b) for a, b in zip(n, m, strict=True)], pa.bool_()))

    return pairs.mapInArrow(run, "f string, n long, m long")


def fit_lexicon(docs: DataFrame, labels: DataFrame, train: Column | None = None, per_class: int = PER_CLASS) -> Lexicon:
    sample = labelled_docs(docs, labels, "toxic", F.lit(True) if train is None else train, per_class).persist()
    try:
        sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
        n_bad, n_fine = sizes.get(1, 0), sizes.get(0, 0)
        if not n_bad or not n_fine:
            return Lexicon({}, base=n_bad / max(1, n_bad + n_fine))

        def all_features(text: str) -> set[str]:
            return {f for w in set(fold_text(text).split()) for f in word_features(w)}

        def odds(a: int, b: int) -> float:
            return math.log((a + 0.5) / (n_bad + 1)) - math.log((b + 0.5) / (n_fine + 1))

        # Every entry is tested before any is collected, so common words crowd none out.
        both = _paired(_counting(sample.where("toxic = 1"), all_features, "n").where("n >= 3"), _counting(sample.where("toxic = 0"), all_features, "m"))
        telling = _where(both, lambda a, b: odds(a, b) >= LEAST_ODDS and _ratio(a, n_bad, b, n_fine) >= LEAST_RATIO)
        weights = {r.f: odds(r.n, r.m) for r in telling.collect()}
        plain = Lexicon(weights)

        def contexts(text: str) -> set[str]:
            folded = fold_text(text)
            return {" ".join(c) for start, (word, _) in plain.matches(folded).items() for c in plain.contexts(folded, start, word)}

        both = _paired(_counting(sample.where("toxic = 0"), contexts, "n").where("n >= 3"), _counting(sample.where("toxic = 1"), contexts, "m"))
        harmless = _where(both, lambda fine, foul: fine * n_bad > 4 * foul * n_fine)
        exceptions = frozenset(tuple((r.f.split(" ") + [""])[:2]) for r in harmless.collect())
        lexicon = Lexicon(weights, exceptions)
        measured = map_texts(sample, lambda t: (lexicon.measure(t),), [("m", pa.float64())], "m double", ["toxic"]).collect()
        lexicon.threshold = _best_threshold([(r.m, r.toxic) for r in measured])
        return lexicon
    finally:
        sample.unpersist()


def _best_threshold(rows: list[tuple[float, int]]) -> float:
    """The cut in the middle of the gap that leaves the fewest rows on the wrong side; harmless rows weigh like toxic ones."""
    rows = sorted(rows)
    n_bad, n_fine = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    wrong = best = 1.0  # everything called toxic
    cut = max(rows[0][0] / 2, 0.1)
    for (m, y), (after, _) in zip(rows, rows[1:] + [(rows[-1][0] + 1, 0)], strict=True):
        wrong += y / n_bad - (1 - y) / n_fine
        if after > m and wrong < best - 1e-12:
            best, cut = wrong, (m + after) / 2
    return max(cut, 0.1)


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out ids are not read."""
    bounded_batches(docs.sparkSession)
    lexicon = fit_lexicon(docs, labels, fold("doc_id", modulus) != held, per_class)
    scored = map_texts(docs.select("doc_id", "text"), lambda t: (lexicon.score(t),), [("score", pa.float64())], "score double", ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", modulus) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
