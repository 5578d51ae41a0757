"""Overlapping pairs against plain Python, and what they move."""

from collections import Counter
from itertools import combinations
import random

import numpy as np

from quern.functions import counting
from quern.operators import passes


def expected(texts, k=5, max_docs=50):
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {" ".join(w[j : j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    df = Counter(s for x in sets.values() for s in x)
    found = {}
    for a, b in combinations(sorted(sets), 2):
        shared = sum(2 <= df[s] <= max_docs for s in sets[a] & sets[b])
        if shared and shared >= min(len(sets[a]), len(sets[b])) * 0.75:
            found[a, b] = (shared, shared / min(len(sets[a]), len(sets[b])), shared / (len(sets[a]) + len(sets[b]) - shared))
    return found


def texts():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    out = {}
    for i in range(160):
        if i % 4 and out:
            base = draw.choice(list(out.values())).split()
            at = draw.randrange(len(base))
            base[at : at + draw.randrange(3)] = [draw.choice(words)]
            out[draw.choice([1, -1]) * (i + 1)] = " ".join(base[: draw.randrange(len(base) // 2, len(base) + 1)] + ["Edge"])
        else:
            out[i + 1] = " ".join(draw.choices(words, k=draw.randrange(1, 60)))
    for i in range(500, 552):  # one shingle more often than the cap, one just as often
        out[i] = f"one two three four five own{i} " + ("six seven eight nine ten" if i < 550 else "x")
    return out | {900: None, 901: " ", 902: "Short  text", 903: "short text"}


def test_pairs_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(passes, "PART_CHARS", 500)
    monkeypatch.setattr(passes, "SENT", 300)
    monkeypatch.setattr(passes, "PAIRS", 100)
    rows = texts()
    df = spark.createDataFrame(list(rows.items()), "ord long, text string").repartition(3)
    got = {(r.a, r.b): (r.shared, r.overlap, r.jaccard) for r in passes.overlap_pairs(df).collect()}
    assert got == expected(rows) and len(got) > 50


def test_a_common_shingle_is_sent_a_bounded_number_of_times():
    h = np.full(10_000, 7, np.uint64)
    lot = passes._dealt(h, np.arange(10_000), np.ones(10_000, np.int32), 4, 50)
    assert len(passes._unpacked(lot.column("ord").to_pylist(), np.int64)) == 51


def test_hashes_are_moved_once(spark):
    df = spark.createDataFrame([(i, f"a b c d e f {i}") for i in range(20)], "ord long, text string")
    plan = passes.overlap_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 2


def test_shingle_hashes_follow_the_words():
    one = counting.shingle_hashes("a b c d e f g")
    assert len(one) == 3 and set(counting.shingle_hashes("b c d e f")) < set(one)
    assert len(counting.shingle_hashes("")) == 0 and len(counting.shingle_hashes("a b")) == 1
    assert counting.shingle_hashes("a b") != counting.shingle_hashes("b a")
