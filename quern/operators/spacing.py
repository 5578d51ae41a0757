"""Spacing repair: long runs of letters that are several words run together are split again.

The splitter is a unigram model: the parts of the cheapest segmentation, where a word costs the
negative logarithm of its share.  The vocabulary is counted on the corpus itself and bounded.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.session import ship

# The shortest run looked at, and the shortest part accepted.
RUN, PART = 19, 2
_RUN = re.compile(rf"[A-Za-z]{{{RUN},}}")
#: Words that the vocabulary holds at most: it is what tasks carry.
MOST_WORDS = 50_000


def vocabulary(records: DataFrame, most: int = MOST_WORDS) -> dict[str, int]:
    """Counts of the most frequent plain words that are shorter than a run, over all records."""
    words = records.select(F.explode(T.words(F.lower(T.filled("text")))).alias("w")).where(F.col("w").rlike(rf"^[a-z]{{{PART},{RUN - 1}}}$"))
    top = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(most)
    return {r.w: r.n for r in top.collect()}


def splitter(counts: dict[str, int]) -> Callable[[str], list[str]]:
    """The cheapest segmentation of a word; letters that no word covers stand alone, at a high cost."""
    total = sum(counts.values()) + 1
    cost = {w: math.log(total / n) for w, n in counts.items()}
    unknown = 2 * math.log(total) + 10
    longest = max(map(len, cost), default=1)

    def split(word: str) -> list[str]:
        low, n = word.lower(), len(word)
        best, cut = [0.0] + [math.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for begin in range(max(0, end - longest), end):
                price = best[begin] + cost.get(low[begin:end], unknown if end - begin == 1 else math.inf)
                if price < best[end]:
                    best[end], cut[end] = price, begin
        parts, end = [], n
        while end:
            parts.append(word[cut[end] : end])
            end = cut[end]
        return parts[::-1]

    return split


def respace(text: str, split: Callable[[str], list[str]]) -> str:
    """``text`` with its long lower-case runs split where every part is a word.

    A run with a capital stays as it is: the rule only accepts a split whose lower-case parts
    rebuild it.
    """

    def parts(run: re.Match[str]) -> str:
        found = split(run[0]) if run[0].islower() else []
        return " ".join(found) if len(found) > 1 and min(map(len, found)) >= PART else run[0]

    return _RUN.sub(parts, text)


def repair_spacing(records: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """``records`` with run-together words split; only texts with a long run go through Python."""
    ship(records.sparkSession)
    split = splitter(vocabulary(records) if counts is None else counts)

    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: respace(t, split))

    text = T.filled("text")
    return records.withColumn("text", F.when(text.rlike(rf"[A-Za-z]{{{RUN},}}"), run(F.when(text.rlike(rf"[A-Za-z]{{{RUN},}}"), text).otherwise(F.lit("")))).otherwise(text))
