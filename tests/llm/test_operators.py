"""The training-data operators against brute force and on edge cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quern.llm import chat_format, decontaminate, exact_dedup, html_extract, jaccard_join, langid, mixing, quality, toxicity, url_filter
from quern.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, source=None):
    return spark.createDataFrame([(i, t, "en", source(i) if source else "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def test_url_filter_cascade_is_exact(spark):
    hosts = [f"h{i}.example.net" for i in range(400)]
    urls = [f"http://{h}/x" for h in hosts] + [None, "nothing", "http://EXAMPLE.com/de/a?x", "https://a.b.example.net/en/#t", "http://example.org/fr/", "http://example.org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = hosts[::3]
    got = {r.page_id: r for r in url_filter.filter_urls(pages, {("org", "/fr/"): "allow", ("example.com", "/de/"): "block"}, listed).collect()}
    assert all(got[i].listed == (i % 3 == 0) and got[i].verdict == ("block" if i % 3 == 0 else "allow") for i in range(400))
    assert (got[400].host, got[400].path, got[401].rule) == ("", "", None)
    assert (got[402].host, got[402].rule, got[402].verdict) == ("example.com", "example.com/de/", "block")
    assert got[404].rule == "org/fr/" and got[405].rule is None
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_exact_dedup(spark):
    got = {r.doc_id: r for r in exact_dedup.dedup_classes(docs(spark, ["a", "b", "a", None, "", "a "])).collect()}
    assert [got[i].keep_id for i in range(6)] == [2, 1, 2, 4, 4, 5]
    assert got[0].group_size == 3 - 1 and got[2].kept and not got[0].kept
    assert sorted(r.doc_id for r in exact_dedup.dedup(docs(spark, ["a", "b", "a", None, ""])).collect()) == [1, 2, 4]
    assert exact_dedup.dedup_classes(docs(spark, ["a"]).limit(0)).count() == 0


def test_chats_collapse_prefixes_and_copies(spark):
    def chat(c, *texts):
        return [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]

    rows = chat(1, "a", "b") + chat(2, "a", "b", "c") + chat(3, "a", "x") + chat(4, "a", "x") + [(None, 0, "user", "z"), (5, None, None, None)]
    got = {r.conv_id: r for r in chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {2, 3, 5} and got[3].copies == 2 and got[2].n_turns == 3
    assert got[5].rendered == "<|unknown|>\n\n<|end|>"


def test_schedule_stays_within_one_block():
    for seed in range(30):
        shares = [random.Random(seed * 9 + k).randint(1, 20) for k in range(6)]
        total, ran = sum(shares), [0] * 6
        for t, q in enumerate(mixing.schedule(shares), 1):
            ran[q] += 1
            assert all(abs(ran[k] - t * shares[k] / total) < 1 for k in range(6))
        assert ran == shares


def test_mix_keeps_every_row(spark):
    d = docs(spark, ["t"] * 300, lambda i: ["hot", "src0", None][0 if i % 3 else i % 2 + 1])
    rows = mixing.mix(d, chunk_rows=16).collect()
    assert len(rows) == 300 == len({r.position for r in rows})
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(d, chunk_rows=10_000).collect()))


def brute_components(texts):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and 100 * inter >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("per_task", [512, 6])
def test_jaccard_join_is_exact(spark, per_task):
    """Chains of edits, so that links, windows and large regions (per_task 6) all occur."""
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    texts = [None, "", " \t ", "one", "ONE", "one two three"]
    for _ in range(6):
        base = [rng.choice(vocab) for _ in range(70)]
        for _ in range(14):
            base = list(base)
            for _ in range(rng.randint(0, 2)):
                base[rng.randrange(len(base))] = rng.choice(vocab)
            texts.append(" ".join(base))
    want = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs(spark, texts), per_task, 2, 64, 12).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.jaccard_components(docs(spark, ["x"]).limit(0)).count() == 0
    assert [tuple(r) for r in jaccard_join.jaccard_components(docs(spark, [None])).collect()] == [(0, 0, 0)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def edit_distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_decontamination_equals_alignment(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = [" ".join(word() for _ in range(20)) for _ in range(5)]
    texts = [None, "", items[0], "x" * 10]
    for k in range(40):
        leak = list(items[k % 5])
        for _ in range(k // 3):
            at = rng.randrange(len(leak))
            leak[at : at + 1] = rng.choice(["", "z", leak[at] + "q"])
        texts.append(" ".join(word() for _ in range(30)) + " " + "".join(leak) + " " + " ".join(word() for _ in range(30)))
    bench = spark.createDataFrame([*enumerate(items), (9, None), (10, "short")], "item_id long, text string")
    got = {r.doc_id: list(r.item_ids) for r in decontaminate.find_leaks(docs(spark, texts), bench).collect()}
    plain = lambda t: "".join(c for c in (t or "").lower() if c.isalnum())
    index = decontaminate.Index(list(enumerate(items)))
    for i, t in enumerate(texts):
        assert got[i] == [x.item_id for x in index.items if edit_distance_inside(x.text, plain(t)) <= x.edits]
    assert decontaminate.find_leaks(docs(spark, ["a"]), bench.limit(0)).first().contaminated is False


def test_classifiers_learn_and_cope(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice("the keep stands above a river and its gate is barred".split()) for _ in range(60)) + "." for _ in range(80)]
    bad = [re.sub(" ", "### ", g) for g in good]
    d = docs(spark, [*good, *bad, None, ""])
    labels = spark.createDataFrame([(i, int(i < 80), int(i % 2)) for i in range(160)], "doc_id long, quality int, toxic int")
    rows = quality.classify_quality(d, labels).where("doc_id < 160").collect()
    assert sum(r.predicted == int(r.doc_id < 80) for r in rows) >= 156
    foul = docs(spark, [g + (" you 1di0t" if i % 2 else " friend") for i, g in enumerate(good)] + [None])
    rows = toxicity.score_toxicity(foul, labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id < 80) and all(0 <= r.score <= 1 for r in rows)
    empty = labels.limit(0)
    assert {r.score for r in quality.classify_quality(d, empty).collect()} == {0.5}
    assert {r.score for r in toxicity.score_toxicity(d, empty).collect()} == {0.0}


def test_language_identification(spark):
    d = docs(spark, ["the river and the gate of the keep"] * 20 + ["der fluss und das tor der burg"] * 20 + [None, "123 --"]).withColumn("lang", F.when(F.col("doc_id") < 20, "en").when(F.col("doc_id") < 40, "de"))
    got = {r.doc_id: r.lang_pred for r in langid.identify(d).collect()}
    assert all(got[i] == ("en" if i < 20 else "de") for i in range(40)) and got[40] == got[41] == "und"
    assert {r.lang_pred for r in langid.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_html(spark):
    para = "<p>The gate, barred with iron, has not been opened since the war &amp; nobody goes there now, or so they say.</p>"
    page = f"<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><div class='ad'>buy, buy, buy this thing today</div><article><h1>Head</h1>{para}<p><b>Open<br>{para}</article><div id=comments>{para}</div><footer>foot</footer>"
    text = html_extract.extract(page)
    body = "The gate, barred with iron, has not been opened since the war & nobody goes there now, or so they say."
    assert text == f"Head\n{body}\nOpen\n{body}"
    rows = html_extract.extract_pages(spark.createDataFrame([(1, "u", None), (2, "u", "<p>x")], "page_id long, url string, html string")).collect()
    assert [(r.text, r.n_chars) for r in rows] == [("", 0), ("x", 1)]
