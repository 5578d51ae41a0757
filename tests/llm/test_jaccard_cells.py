"""Cells, guests and rows of the Jaccard join, against all pairs."""

import random
import re

import numpy as np
import pytest

from quern.llm import jaccard_join
from quern.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """n_shingles, component's smallest doc_id and number of linked rows of each (doc_id, text)."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    near = [[j for j in range(len(sets)) if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])] for i in range(len(sets))]
    part = list(range(len(sets)))
    while (after := [min([part[i], *(part[j] for j in near[i])]) for i in range(len(sets))]) != part:
        part = after
    ids = {}
    for (i, _), p in zip(rows, part, strict=True):
        if i is not None:
            ids[p] = min(i, ids.get(p, i))
    return [(len(s), ids.get(p), len(x)) for s, p, x in zip(sets, part, near, strict=True)], part


def family(rng, n, most, vocab, words=60):
    base = [rng.choice(vocab) for _ in range(words)]
    out = []
    for _ in range(n):
        base = list(base)
        for _ in range(rng.randint(0, most)):
            base[rng.randrange(len(base))] = rng.choice(vocab)
        out.append(" ".join(base))
    return out


def shuffled_rows(seed):
    """Chains and tight groups, exact copies, ids that repeat on other texts, and rows without id."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = [None, "", " ", "one", "ONE", "a b c"] + [t for k in (0, 1, 2, 3) for t in family(rng, 16, k, vocab)]
    texts += rng.sample(texts, 12)
    rng.shuffle(texts)
    return [(None if i % 9 == 0 else i if i % 4 else i // 8, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("per_task", "seed"), [(512, 1), (12, 2)])
def test_rows_with_repeated_and_missing_ids(spark, per_task, seed):
    rows = shuffled_rows(seed)
    want, part = brute(rows)
    d = spark.createDataFrame([(i, t, str(at), "s", 1) for at, (i, t) in enumerate(rows)], DOCS)
    got = jaccard_join.jaccard_links(d, per_task, 2, 64, 12).collect()
    empties = lambda r: r[1] if r[0] else None  # noqa: E731 - rows without words are their own
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted([(i, n, empties((n, c)), k) for (i, _), (n, c, k) in zip(rows, want, strict=True)], key=key) == sorted([(r.doc_id, r.n_shingles, empties((r.n_shingles, r.component_id)), r.n_links) for r in got], key=key)
    if per_task < 512:
        return
    kept = {int(r.lang) for r in jaccard_join.keep_one(d, per_task, 2).collect()}
    assert len(kept) == len(set(part)) and {part[at] for at in kept} == set(part)
    for at in kept:  # the one with the smallest id
        assert rows[at][0] == want[at][1] or want[at][0] == 0


def test_row_that_shares_an_id_with_a_near_copy_stays(spark):
    a, b = "alpha beta gamma delta epsilon zeta", " ".join(f"word{i}" for i in range(60))
    rows = [(3, a, "en", "s", 1), (3, b, "en", "s", 1), (1, b + " more", "en", "s", 1)]
    d = spark.createDataFrame(rows, DOCS)
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.n_links) for r in jaccard_join.jaccard_links(d).collect()}
    assert got == {(3, 2): (3, 0), (3, 56): (1, 1), (1, 57): (1, 1)}
    assert sorted((r.doc_id, r.text[:5]) for r in jaccard_join.keep_one(d).collect()) == [(1, "word0"), (3, "alpha")]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("natives", [200, 120])
def test_join_sets_equals_all_pairs(seed, natives):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)]
    texts = [t for k in (0, 1, 2, 6) for t in family(rng, 50, k, vocab)]
    rng.shuffle(texts)
    sets = [jaccard_join.shingles(t) for t in texts]
    weight = np.array([rng.randint(1, 3) for _ in sets])
    link = jaccard_join.links_between(sets)
    link[natives:, natives:] = False
    for inner in (True, False):
        met = link.copy()
        if not inner:
            met[:natives, :natives] = False
        parts, sums = jaccard_join.join_sets(sets, natives, weight, inner)
        assert sums.tolist() == (met @ weight).tolist()
        root = list(range(len(sets)))
        while (after := [min([root[i], *(root[j] for j in np.flatnonzero(met[i]))]) for i in range(len(sets))]) != root:
            root = after
        assert parts == root
        assert jaccard_join.join_sets(sets, natives, None, inner)[0] == root


@pytest.mark.parametrize(("per_task", "elements"), [(40, 1 << 23), (512, 3000)])
def test_split_again_and_rounds(spark, monkeypatch, per_task, elements):
    """A region that many documents chain into by shared passages, few of which link; large by its
    sets, or by their elements."""
    rng = random.Random(9)
    passages = [" ".join(f"p{k}x{i}" for i in range(12)) for k in range(30)]
    texts = [" ".join(rng.sample(passages, 5)) for _ in range(100)]
    texts += [t + " end" for t in texts[:20]]
    rows = list(enumerate(texts))
    want, _ = brute(rows)
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    monkeypatch.setattr(jaccard_join, "ELEMENTS", elements)
    monkeypatch.setattr(jaccard_join, "BLOCKS", 1)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.jaccard_links(d, per_task, 4, 64, 8).collect()}
    assert [got[i] for i, _ in rows] == want


def test_components_of_hubs(spark, monkeypatch):
    monkeypatch.setattr("quern.llm.components.DEGREE", 8)
    edges = [(0, i) for i in range(1, 400)] + [(1000, i) for i in range(600, 1000)] + [(399, 2000), (2000, 3000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == dict.fromkeys([*range(400), 2000, 3000], 0) | dict.fromkeys(range(600, 1001), 600)


@pytest.fixture
def many_partitions(spark):
    """32 shuffle partitions that stay as they are; yields a function that counts the jobs of a call."""
    held = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)

    def jobs_of(call):
        group = f"jobs-{random.random()}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            out = call()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    yield jobs_of
    for k, v in before.items():
        spark.conf.set(k, v)


def graph(seed):
    """Chains in both directions, stars, cliques and random edges, with repeats, loops and negative nodes."""
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(300)] + [(-i, -i - 1) for i in range(1000, 1300)] + [(500, i) for i in range(501, 700)] + [(999, i) for i in range(800, 900)]
    edges += [(i, j) for i in range(2000, 2015) for j in range(2000, 2015)] + [(rng.randint(3000, 3400), rng.randint(3000, 3400)) for _ in range(250)]
    edges += [(-(1 << 63), (1 << 63) - 1), (4000, 4000)] + rng.sample(edges, 50)
    rng.shuffle(edges)
    root = {n: n for n in {x for a, b in edges if a != b for x in (a, b)}}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return edges, root


@pytest.mark.parametrize("seed", range(3))
def test_small_graph_takes_few_jobs(spark, many_partitions, seed):
    """Rounds over a small graph cost the driver some 16 jobs each, of a task for each partition."""
    edges, want = graph(seed)
    got, jobs = many_partitions(lambda: components(spark.createDataFrame(edges, "a long, b long"), "test").collect())
    assert len(got) == len(want) and {r.node: r.root for r in got} == want
    assert 0 < jobs <= 8


def test_graphs_above_the_limit_take_rounds(spark, monkeypatch):
    edges, want = graph(7)
    edges = spark.createDataFrame(edges, "a long, b long")
    monkeypatch.setattr("quern.llm.components.DEGREE", 8)
    for limit in (0, edges.where("a <> b").selectExpr("least(a, b)", "greatest(a, b)").distinct().count() - 1):
        monkeypatch.setattr("quern.llm.components.FEW_EDGES", limit)
        monkeypatch.setattr("quern.llm.components._joined_by_one", None)
        got = components(edges, "test").collect()
        assert len(got) == len(want) and {r.node: r.root for r in got} == want


def test_components_of_no_edges_and_of_names(spark):
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"), "test").collect() == []
    got = components(spark.createDataFrame([("b", "a"), ("c", "b"), ("y", "x")], "a string, b string"), "test").collect()
    assert {r.node: r.root for r in got} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}


def test_map_of_repeated_elements_comes_in_few_jobs(spark, many_partitions):
    texts = [" ".join(f"w{i % 700}x{i % 3}" for i in range(k, k + 60)) for k in range(0, 3000, 20)]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    seen = np.concatenate([jaccard_join.shingles(t) for t in texts])
    values, counts = np.unique(seen, return_counts=True)
    table = jaccard_join.element_counts(d, 8)
    got, jobs = many_partitions(lambda: jaccard_join.repeated_map(table, 8, 16))
    marked = set(np.flatnonzero(np.unpackbits(got, bitorder="little")).tolist())
    assert marked == set((values[counts > 1] >> np.uint64(48)).astype(int).tolist()) and len(marked) > 300
    assert 0 < jobs <= 14
