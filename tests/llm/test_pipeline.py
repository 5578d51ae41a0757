"""The five stages on a small corpus, against plain versions of their rules."""

import hashlib
import random
import re

import pytest

import corpus_pipeline
from quern.llm import mixing, quality
from quern.llm.common import fold, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    words = "the keep stands above a river and its gate is barred with seven iron bars while snow falls on old towers of grey stone".split()
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))
    good = [prose(rng.randint(40, 80)) for _ in range(50)]
    junk = [" ".join(rng.choice(["####", "$$$ 000", "|", "!!!", "@@"]) for _ in range(60)) for _ in range(30)]
    item = "which seven iron gates were opened by the grey wardens of the northern river"
    texts = [*good, *junk, good[0], good[1], good[1], good[2] + " more", good[3] + " again", good[4] + " " + item, item.upper(), None, "", good[5] + "\n" + good[5]]
    rows = [(i, t, "en", ["src0", "hot", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, good[6], "en", "hot", 1), (7, good[7], "en", "src0", 1)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 50), 0) for i in range(0, 80)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def shingled(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def edits_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_run_equals_plain_rules(spark, corpus):
    path, rows = corpus
    docs, labels = table(spark, path, "documents"), table(spark, path, "labels")
    model = quality.fit_quality(docs, labels, fold("doc_id", 3) != 1)
    left = [r for r in rows if model.judge([r[1]])[0] >= 0.5]
    assert sum(r[0] is not None and r[0] < 50 for r in left) >= 48 and not any(r[0] is not None and 50 <= r[0] < 80 for r in left)
    best = {}
    for r in left:  # of one text the largest id
        key = r[1] or ""
        if key not in best or (r[0] is not None, r[0] or 0) > (best[key][0] is not None, best[key][0] or 0):
            best[key] = r
    left = list(best.values())
    sets = [shingled(r[1]) for r in left]
    part = list(range(len(left)))
    for _ in left:
        for i in range(len(left)):
            for j in range(i):
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    part[i] = part[j] = min(part[i], part[j])
    least = {}
    for r, p in zip(left, part, strict=True):
        key = (r[0] is None, r[0] or 0)
        if p not in least or key < least[p][0]:
            least[p] = (key, r)
    left = [r for _, r in least.values()]
    plain = lambda t: "".join(c for c in (t or "").lower() if c.isalnum())
    item = plain("which seven iron gates were opened by the grey wardens of the northern river")
    left = [r for r in left if edits_inside(item, plain(r[1])) > int(0.08 * len(item))]
    got = corpus_pipeline.run(spark, path).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((r[0], r[1]) for r in left), key=str)
    # The mix: rows of a queue in the order of a hash, in the slots of the schedule.
    names = [*mixing.SHARES, "rest"]
    weights = [*mixing.SHARES.values(), mixing.REST_SHARE]
    slots = mixing.schedule(weights)
    for k, name in enumerate(names):
        own = sorted((r for r in got if r.queue == name), key=lambda r: r.position)
        assert {r.source if r.source in mixing.SHARES else "rest" for r in own} <= {name}
        ids = [hashlib.md5(str(r.doc_id).encode()).hexdigest() for r in own if r.doc_id is not None]
        assert ids == sorted(ids)
        turns = [t for t, q in enumerate(slots) if q == k]
        want = [((n // mixing.BLOCK) // weights[k] * len(slots) + turns[(n // mixing.BLOCK) % weights[k]]) * mixing.BLOCK + n % mixing.BLOCK for n in range(len(own))]
        assert [r.position for r in own] == want


def test_stages_keep_columns_and_empty_tables(spark, corpus):
    path, _ = corpus
    docs = table(spark, path, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), path)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), path).count() == 0
