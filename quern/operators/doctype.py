"""Document types by weighted counts of telling phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T

# Phrases (regular expressions, case ignored) and their weights.
SIGNALS = {
    "bestiary": {
        r"\barmor class\b": 3,
        r"\bhit points\b": 3,
        r"\bchallenge\b": 2,
        r"\blegendary action": 4,
        r"\bmultiattack\b": 4,
        r"\bmelee weapon attack\b": 3,
        r"\bdamage (immunit|resistance|vulnerabilit)": 3,
        r"\brecharge\b": 2,
        r"\bstr\b.{0,15}\bdex\b.{0,15}\bcon\b": 4,
    },
    "adventure": {
        r"\bthe (characters|party|adventurers|heroes)\b": 3,
        r"\bread[- ]?aloud\b": 4,
        r"\bboxed text\b": 4,
        r"\bif the (characters|party|players|adventurers)\b": 3,
        r"\bwhen the (characters|party|adventurers) (enter|arrive|reach|open)": 3,
        r"\b(area|room) \d+\b": 2,
        r"\bdevelopment\b": 1,
        r"\btreasure\b": 1,
        r"\bdungeon master\b": 1,
    },
    "rules": {
        r"\bat higher levels\b": 4,
        r"\bproficiency bonus\b": 3,
        r"\bwhen you\b": 2,
        r"\byou gain\b": 2,
        r"\bability (check|score)\b": 2,
        r"\bsaving throw\b": 1,
        r"\b\d+(st|nd|rd|th)[- ]level\b": 2,
        r"\bthe rules\b": 2,
        r"\bchapter \d+\b": 2,
    },
}
CONFIDENT = 0.45


def hits(col: Column, kind: str) -> Column:
    """Weighted count of the kind's phrases."""
    parts = [F.regexp_count(col, F.lit(f"(?is){p}")) * w for p, w in SIGNALS[kind].items()]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def classify(records: DataFrame, sample_chars: int | None = None) -> DataFrame:
    """ord, hits and rates by type, doc_type (null where nothing fits), confidence, confident.

    Confidence is the lead over the second type as a share of all hits; the rate is per 1,000
    words.  ``sample_chars`` restricts the reading to the beginning, for previews.
    """
    text = T.filled("text") if sample_chars is None else F.substring(T.filled("text"), 1, sample_chars)
    rows = records.select("ord", F.greatest(F.size(T.words(text)), F.lit(1)).alias("n_words"), *(hits(text, k).alias(k) for k in SIGNALS))
    total = sum((F.col(k) for k in SIGNALS), F.lit(0))
    ranked = F.sort_array(F.array(*(F.col(k) for k in SIGNALS)), asc=False)
    best = F.lit(None).cast("string")
    for k in reversed(SIGNALS):  # the first type wins a tie
        best = F.when(F.col(k) == F.greatest(*SIGNALS), F.lit(k)).otherwise(best)
    lead = F.when(total > 0, (ranked[0] - ranked[1]) / total).otherwise(0.0)
    rows = rows.withColumns({f"{k}_rate": F.col(k) * 1000 / F.col("n_words") for k in SIGNALS} | {"doc_type": F.when(total > 0, best), "confidence": lead})
    return rows.withColumn("confident", F.col("doc_type").isNotNull() & (F.col("confidence") >= CONFIDENT))
