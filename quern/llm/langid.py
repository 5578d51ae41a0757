"""Language identification by nearest centroid.

A text becomes the counts of its letter n-grams (two and three letters, words apart by one
blank, lower-cased), hashed to a fixed number of places, weighted by inverse document frequency
and normalised.  Every language has several centroids, found by clustering its sample with
cosine k-means: one for its plain prose, others for its odd registers.  A text takes the
language of the centroid with the greatest cosine; it is marked rejected where that cosine lies
below what the centroid's own members reach.

The centroids are fitted on a bounded sample: ``sample_rows`` rows over all languages, shared
out evenly and chosen by a hash of the id, whatever the table holds (repeated ids, a language
column of any number of values).  Every text is read whole.

Defined results
    a null text and a text without letters are ``und`` with score 0 and rejected; with nothing
    to learn from, every text is ``und``; an empty table gives an empty result; repeated rows
    give equal results; equal cosines go to the language first in alphabetical order; very long
    texts are counted as any other; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, codepoints, fold, map_texts, stratified_sample

SAMPLE_ROWS = 2400
CENTROIDS = 4
PLACES = 1 << 12
PIECE = 1 << 21
#: Rows of a language that its centroids need; so SAMPLE_ROWS // LEAST_ROWS languages (the most
#: frequent ones) can be learned, and no more are.
LEAST_ROWS = 8
#: A text is rejected below this share of a centroid members' tenth-percentile cosine.
REJECT = 0.6

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _LETTER[0]


def _add(counts: np.ndarray, h: np.ndarray) -> None:
    h = h ^ (h >> np.uint32(15))
    h = h * np.uint32(0x2C1B3C6D)
    counts += np.bincount((h >> np.uint32(20)).astype(np.int64), minlength=PLACES)


def ngram_counts(text: str) -> np.ndarray | None:
    """Hashed 2- and 3-gram counts of a whole text, words between blanks; None where it has no letter."""
    counts, seen, tail = np.zeros(PLACES, np.int64), False, np.array([32], np.uint32)
    table = _letters()
    for at in range(0, len(text) + PIECE, PIECE):
        # After the last piece comes a closing blank.
        cp = codepoints(text[at : at + PIECE].lower() or " ")
        letter = table[cp]
        seen = seen or bool(letter.any())
        cp = np.where(letter, cp, np.uint32(32))
        cp = np.concatenate([tail, cp])
        blank = cp == 32
        cp = cp[~(blank & np.concatenate([[False], blank[:-1]]))]
        two = cp[:-1] * np.uint32(0x9E3779B1) + cp[1:] * np.uint32(0x85EBCA77)
        if len(cp) >= 3:
            _add(counts, two[:-1])
            _add(counts, (two[:-1] + cp[2:] * np.uint32(0xC2B2AE3D)) ^ np.uint32(0x27D4EB2F))
        tail = cp[-2:]
    if not seen:
        return None
    _add(counts, two[-1:])  # the pairs before it were counted with the triple that they begin
    return counts


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Cosine k-means from a farthest-first start; centroids and each row's cluster."""
    chosen = [int(np.argmax(x @ _unit(x.mean(0))))]
    while len(chosen) < min(k, len(x)):
        nearest = (x @ x[chosen].T).max(1)
        chosen.append(int(np.argmin(nearest)))
    centres = x[chosen]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        centres = np.stack([_unit(x[own == j].mean(0)) if (own == j).any() else centres[j] for j in range(len(centres))])
    return centres, (x @ centres.T).argmax(1)


@dataclass
class Centroids:
    idf: np.ndarray
    centres: np.ndarray
    langs: list[str]
    floor: np.ndarray

    @classmethod
    def fit(cls, counts: np.ndarray, langs: list[str], k: int = CENTROIDS) -> Centroids | None:
        if not langs:
            return None
        idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
        x = _unit(np.log1p(counts).astype(np.float32) * idf)
        centres, names, floor = [], [], []
        for lang in sorted(set(langs)):
            own = x[[i for i, v in enumerate(langs) if v == lang]]
            found, member = cluster(own, k)
            cosines = (own @ found.T).max(1)
            for j in range(len(found)):
                centres.append(found[j])
                names.append(lang)
                floor.append(float(np.quantile(cosines[member == j], 0.1)) * REJECT if (member == j).any() else 0.0)
        return cls(idf, np.stack(centres), names, np.array(floor))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = ngram_counts(text or "")
        if counts is None:
            return "und", 0.0, True
        cosine = self.centres @ _unit(np.log1p(counts).astype(np.float32) * self.idf)
        best = int(np.argmax(cosine))
        score = float(min(1.0, max(0.0, cosine[best])))
        return self.langs[best], score, score < self.floor[best]


def pack_counts(counts: np.ndarray) -> bytes:
    """The places that are not zero, then their counts."""
    at = np.flatnonzero(counts)
    return at.astype("<u2").tobytes() + np.minimum(counts[at], 2**32 - 1).astype("<u4").tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    n = len(blob) // 6
    out = np.zeros(PLACES, np.int64)
    out[np.frombuffer(blob, "<u2", n)] = np.frombuffer(blob, "<u4", n, 2 * n)
    return out


def language_sample(docs: DataFrame, train: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, lang: the bounded sample that the centroids are fitted on."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.lit(True) if train is None else train)).select("doc_id", "lang", "text")
    most = max(1, sample_rows // LEAST_ROWS)
    n_langs = min(most, max(1, rows.select("lang").distinct().limit(most).count()))
    return stratified_sample(rows, "lang", max(1, sample_rows // n_langs), most).withColumnRenamed("lang", "_lang")


def fit_languages(docs: DataFrame, train: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Centroids | None:
    def row(text: str) -> tuple:
        counts = ngram_counts(text)
        return (None if counts is None else pack_counts(counts),)

    got = map_texts(language_sample(docs, train, sample_rows), row, [("v", pa.binary())], "v binary", ["doc_id", "_lang"]).where("v is not null").orderBy("doc_id", "_lang", "v").collect()
    counts = np.stack([unpack_counts(r.v) for r in got]) if got else np.zeros((0, PLACES))
    return Centroids.fit(counts, [r._lang for r in got])


def identify(docs: DataFrame, modulus: int = 4, held: int = 2, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; langs of held-out ids are not read."""
    bounded_batches(docs.sparkSession)
    model = fit_languages(docs, fold("doc_id", modulus) != held, sample_rows)

    def row(text: str) -> tuple:
        return model.predict(text) if model else ("und", 0.0, True)

    fields = [("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]
    found = map_texts(docs.select("doc_id", "text"), row, fields, "lang_pred string, score double, rejected boolean", ["doc_id"])
    return found.select("doc_id", (fold("doc_id", modulus) == held).alias("held_out"), "lang_pred", "score", "rejected")
