"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each document becomes a vector of statistics, transformed (logs, logits) so that they are
about normal.  Each class has a mean and a covariance, shrunk towards the pooled covariance
and towards a multiple of the identity.  The score is the logistic of the difference of the
two log densities, each a Mahalanobis distance solved with the class's cached Cholesky factor
plus its log determinant, and of the log prior.

The classifier is fitted on a bounded sample of labelled rows (``per_class`` of each label,
chosen by a hash of the id); statistics are taken over whole texts.

Defined results
    null and empty texts have the statistics of an empty text and are scored like any other;
    without labels of both classes every score is the share of label 1 among those seen (0.5
    if none); labels other than 0 and 1 are not read; a class of one row, or of repeated rows, leans on the pooled covariance and on a least
    spread; an empty table gives an empty result; repeated rows get equal scores; several
    labels of one id count as their largest, of several texts of one id the first speaks; very
    long texts are read whole; a score of exactly one half counts as good; other columns,
    whatever their names, are not read, and ``keep_good`` passes them on as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, codepoints, fold, labelled_docs, map_texts

#: Labelled rows of each class that the fit uses, at most about.
PER_CLASS = 4000
#: Weight of the pooled covariance and of the scaled identity in a class's covariance.
TO_POOLED, TO_IDENTITY = 0.1, 0.02
#: Least scale of that identity, in squared standard deviations, and the deviation below which a
#: statistic counts as constant in the sample: no class is too small, or too uniform, to be fitted.
LEAST_SPREAD, CONSTANT = 0.05, 1e-3
#: Code points handled at once in one document.
PIECE = 1 << 21

_LOWER, _UPPER, _DIGIT, _SPACE, _NEWLINE, _STOP, _BAR, _SYMBOL, _OTHER = range(9)


def _classes() -> np.ndarray:
    """The character class of each code point."""
    table = np.full(0x110000, _OTHER, np.uint8)
    for c in range(0x3000):
        ch = chr(c)
        if ch.isupper():
            table[c] = _UPPER
        elif ch.isalpha():
            table[c] = _LOWER
        elif ch.isdigit():
            table[c] = _DIGIT
        elif ch.isspace():
            table[c] = _SPACE
        elif ch in ".,;:!?'\"()-":
            table[c] = _STOP
        elif ch == "|":
            table[c] = _BAR
        elif ch in "#$%&*@^~<>{}[]\\=+_":
            table[c] = _SYMBOL
    table[0x3000:] = _LOWER
    table[10] = _NEWLINE
    return table


_TABLE: list[np.ndarray] = []


def _logit(part: float, whole: float, usual: float, weight: float) -> float:
    """Log odds of a share, drawn towards its usual value by ``weight`` pseudo-counts: a few
    characters say little about a text."""
    share = (part + weight * usual) / (whole + weight)
    share = min(max(share, 1e-5), 1 - 1e-5)
    return float(np.log(share / (1.0 - share)))


def features(text: str) -> list[float]:
    """Transformed statistics of a whole text."""
    if not _TABLE:
        _TABLE.append(_classes())
    counts = np.zeros(9, np.int64)
    for at in range(0, len(text), PIECE):
        counts += np.bincount(_TABLE[0][codepoints(text[at : at + PIECE])], minlength=9)
    words = text.split()
    n, w = len(text), len(words)
    distinct = len(set(words))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = text.split("\n")
    copies = len(lines) - len(set(lines))
    letters = int(counts[_LOWER] + counts[_UPPER])
    # Distinct words grow slower than words; compare with a square-root law beyond 200 words.
    expected = w if w <= 200 else 200 + (w - 200) ** 0.8
    return [
        float(np.log(n + 40)),
        float(np.log((w + 6) / (n + 40))),
        _logit(letters, n, 0.82, 40),
        _logit(counts[_UPPER], letters, 0.03, 40),
        _logit(counts[_SYMBOL], n, 0.002, 40),
        _logit(counts[_BAR], w, 0.01, 10),
        _logit(counts[_STOP], n, 0.03, 40),
        float(np.sqrt(counts[_DIGIT] / (n + 40))),
        float(np.log((distinct + 10) / (expected + 10))),
        _logit(repeats, max(w - 1, 0), 0.005, 10),
        _logit(copies, len(lines), 0.02, 10),
        _logit(min(text.count("!"), w), w, 0.005, 10),
    ]


@dataclass
class Discriminant:
    """Fitted on vectors: per class the mean, the Cholesky factor, the log determinant and the log prior."""

    base: float
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None
    parts: list[tuple[np.ndarray, np.ndarray, float, float]] | None = None

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Discriminant:
        base = float(y.mean()) if len(y) else 0.5
        if len(set(y.tolist())) < 2:
            return cls(base)
        shift, scale = x.mean(0), x.std(0)
        scale = np.where(scale > CONSTANT, scale, 1.0)
        z = (x - shift) / scale
        groups = [z[y == k] for k in (0, 1)]
        centred = [g - g.mean(0) for g in groups]
        pooled = sum(c.T @ c for c in centred) / len(z)
        parts = []
        for g, c in zip(groups, centred, strict=True):
            own = c.T @ c / len(g)
            weight = max(TO_POOLED, min(1.0, x.shape[1] / len(g)))  # few rows: lean on the pool
            cov = (1 - weight) * own + weight * pooled
            cov = (1 - TO_IDENTITY) * cov + TO_IDENTITY * max(np.trace(cov) / len(cov), LEAST_SPREAD) * np.eye(len(cov))
            factor = np.linalg.cholesky(cov)
            parts.append((g.mean(0), factor, 2 * float(np.log(np.diag(factor)).sum()), float(np.log(len(g) / len(z)))))
        return cls(base, shift, scale, parts)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The score of each row of statistics."""
        if self.parts is None:
            return np.full(len(x), self.base)
        z = (x - self.shift) / self.scale
        density = []
        for mean, factor, log_det, prior in self.parts:
            d = np.linalg.solve(factor, (z - mean).T)
            density.append(-0.5 * ((d * d).sum(0) + log_det) + prior)
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -700, 700)))

    def judge(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text, null as empty."""
        return self.scores(np.array([features(t or "") for t in texts]).reshape(len(texts), -1)) if texts else np.zeros(0)


_FIELDS = [("x", pa.list_(pa.float64()))]


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column | None = None, per_class: int = PER_CLASS) -> Discriminant:
    sample = labelled_docs(docs, labels, "quality", F.lit(True) if train is None else train, per_class)
    rows = map_texts(sample, lambda t: (features(t),), _FIELDS, "x array<double>", ["quality"]).collect()
    x = np.array([r.x for r in rows], float) if rows else np.zeros((0, 1))
    return Discriminant.fit(x, np.array([r.quality for r in rows], int))


def score_quality(docs: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, score, predicted."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.judge(batch.column(1).to_pylist()))], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out ids are not read."""
    bounded_batches(docs.sparkSession)
    model = fit_quality(docs, labels, fold("doc_id", modulus) != held, per_class)
    return score_quality(docs, model).select("doc_id", (fold("doc_id", modulus) == held).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` with their columns, without those scored below one half."""
    bounded_batches(docs.sparkSession)
    model = fit_quality(docs, labels, fold("doc_id", modulus) != held, per_class)
    names, schema = docs.columns, docs.schema

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array(model.judge(texts) >= 0.5))

    return docs.mapInArrow(run, schema).select(*names)
